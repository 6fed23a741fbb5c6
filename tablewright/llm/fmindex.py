"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is a run of whole documents of about SHARD_WORDS words. Its words become symbols (a word that no phrase holds can be in no
occurrence, so a run of such words is one symbol), and the index holds the Burrows-Wheeler transform of that sequence as a
wavelet tree with ranks, and every SAMPLE-th suffix position. All phrases are searched together, last word first, two
ranks a step; rows found walk back to a sampled position. Occurrences that overlap or touch merge to removal spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import stored, texts, worker_cache

WINDOW = 10
SHARD_WORDS = 400_000
SAMPLE = 8
PHRASE_WORDS = 2_000_000  # phrases are searched in blocks of items with about so many words

#: Words are runs of digits, letters a-z and everything beyond ASCII; A-Z are lowered, all else is space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
OTHER = 1  # symbol of words outside the phrases and of document ends; 0 ends the text


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def windows(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if len(words) <= size:
        return [tuple(words)] if words else []
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]


class Phrases:
    """The distinct windows of a block of items, as numbers, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[bytes, ...], set[int]] = {}
        self.items = sorted({i for i, _ in items})
        place = {i: k for k, i in enumerate(self.items)}
        for i, text in items:
            for w in windows(words_of(text)):
                found.setdefault(w, set()).add(place[i])
        for w in sorted(found):
            for x in w:
                self.vocabulary.setdefault(x, OTHER + 1 + len(self.vocabulary))
        self.length = np.array([len(w) for w in sorted(found)], np.int64)
        self.symbols = np.zeros((len(found), WINDOW), np.int64)
        for k, w in enumerate(sorted(found)):
            self.symbols[k, : len(w)] = [self.vocabulary[x] for x in w]
        owners = [sorted(found[w]) for w in sorted(found)]
        self.owner_start = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)
        self.owners = np.array([x for o in owners for x in o], np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` (its last symbol occurs once and is the smallest) in order. The first sort looks at as many symbols as
    fit a word; then the depth doubles, and only suffixes that still tie are sorted again."""
    n, bits = len(s), max(1, int(s.max()).bit_length())
    depth = max(1, 62 // bits)
    padded = np.concatenate([s, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key = (key << bits) | padded[k : k + n]
    sa = np.argsort(key, kind="stable")
    k = key[sa]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    rank = np.empty(n, np.int64)
    while True:
        starts = np.flatnonzero(first)
        group = np.repeat(starts, np.diff(np.append(starts, n)))
        rank[sa] = group
        last = np.append(first[1:], True)
        tied = np.flatnonzero(~(first & last))
        if not len(tied):
            return sa
        some = sa[tied]
        after = some + depth
        key = rank[some] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[tied] = some[order]
        k = key[order]
        first[tied] = np.concatenate([[True], k[1:] != k[:-1]])
        depth *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: one bit of the symbol a level, zeros before ones, with running counts of ones."""

    def __init__(self, s: np.ndarray):
        self.n, self.bits = len(s), max(1, int(s.max()).bit_length())
        self.ones, self.zeros = [], []
        cur = s
        for b in range(self.bits - 1, -1, -1):
            bit = ((cur >> b) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(self.n - int(self.ones[-1][-1]))
            cur = np.concatenate([cur[~bit], cur[bit]])
        # where a symbol's run begins at the bottom
        self.begin = self._down(np.arange(1 << self.bits), np.zeros(1 << self.bits, np.int64))

    def _down(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.ones[level][at]
            at = np.where((c >> b) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``c`` occurs before place ``at``."""
        return self._down(c, at) - self.begin[c]


class FMIndex:
    def __init__(self, s: np.ndarray):
        """``s``: symbols, its last one 0 and no other."""
        sa = suffix_array(s)
        self.last = s[sa - 1]
        self.tree = WaveletTree(self.last)
        counts = np.bincount(s, minlength=1 << self.tree.bits)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.sampled = sa % SAMPLE == 0
        self.place = np.cumsum(self.sampled) - 1
        self.positions = sa[self.sampled]

    def search(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row range of each phrase; empty if it does not occur."""
        low, high = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.tree.n, np.int64)
        known = len(self.before)
        for k in range(symbols.shape[1] - 1, -1, -1):
            live = np.flatnonzero((length > k) & (low < high))
            c = symbols[live, k]
            absent = c >= known
            high[live[absent]] = low[live[absent]]
            live, c = live[~absent], c[~absent]
            low[live], high[live] = self.before[c] + self.tree.rank(c, low[live]), self.before[c] + self.tree.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to a sampled suffix."""
        out, at, steps = np.empty(len(rows), np.int64), rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[at[open_]]
            found = open_[done]
            out[found] = self.positions[self.place[at[found]]] + steps[found]
            open_ = open_[~done]
            c = self.last[at[open_]]
            at[open_] = self.before[c] + self.tree.rank(c, at[open_])
            steps[open_] += 1
        return out


def search_shard(docs: list[list[int]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For a shard of documents as symbols: starts and ends of the merged spans in the shard's words, and each document's items."""
    sizes = np.array([len(d) for d in docs], np.int64)
    total = int(sizes.sum())
    flat = np.fromiter((x for d in docs for x in d), np.int64, total)
    doc_end = np.cumsum(sizes)
    doc_of = np.repeat(np.arange(len(docs)), sizes)
    none = np.empty(0, np.int64)
    # a symbol OTHER between documents, one for each run of other words, and 0 at the end
    symbols = np.insert(flat, doc_end[:-1], OTHER) if len(docs) > 1 else flat
    at_word = np.insert(np.arange(total), doc_end[:-1], -1) if len(docs) > 1 else np.arange(total)
    keep = np.concatenate([[True], ~((symbols[1:] == OTHER) & (symbols[:-1] == OTHER))]) if len(symbols) else np.empty(0, bool)
    symbols, at_word = symbols[keep], at_word[keep]
    if not len(phrases.length) or not len(symbols) or (symbols == OTHER).all():
        return none, none, [none] * len(docs)
    index = FMIndex(np.append(symbols, 0))
    low, high = index.search(phrases.symbols, phrases.length)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return none, none, [none] * len(docs)
    n = (high - low)[hit]
    which = np.repeat(hit, n)
    rows = np.repeat(low[hit], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    start = at_word[index.locate(rows)]
    end = start + phrases.length[which]
    marks = np.zeros(total + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, end, -1)
    inside = np.cumsum(marks[:-1]) > 0
    before = np.concatenate([[False], inside[:-1]])
    before[doc_end[:-1][doc_end[:-1] < total]] = False  # a span ends with its document
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]])
    after[doc_end[doc_end > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    # (document, item) pairs
    n = np.diff(phrases.owner_start)[which]
    owner = phrases.owners[np.repeat(phrases.owner_start[which], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))]
    pairs = np.unique(np.repeat(doc_of[start], n) * len(phrases.items) + owner)
    d, i = pairs // len(phrases.items), pairs % len(phrases.items)
    cuts = np.searchsorted(d, np.arange(len(docs) + 1))
    return starts, ends, [i[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


KIND = "struct<n_words:long,starts:array<long>,ends:array<long>,items:array<string>>"
_ARROW = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def merged(a: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (start, end) in order, those that overlap or touch joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(a):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _prepared(items: tuple[tuple[str, str | None], ...]) -> Phrases:
    return worker_cache(("phrases", hash(items)), lambda: Phrases(list(items)))


def _scanner(items: tuple[tuple[str, str | None], ...]):
    def scan(column: pa.Array, earlier: pa.Array) -> pa.Array:
        phrases = _prepared(items)
        known, rows, held, size = phrases.vocabulary, [], [], 0

        def shard() -> None:
            starts, ends, found = search_shard(held, phrases)
            first = np.concatenate([[0], np.cumsum([len(d) for d in held])]).astype(np.int64)
            cuts = np.searchsorted(starts, first)
            for k, d in enumerate(held):
                part = slice(cuts[k], cuts[k + 1])
                rows.append((len(d), (starts[part] - first[k]).tolist(), (ends[part] - first[k]).tolist(), [phrases.items[x] for x in found[k].tolist()]))
            held.clear()

        for t in texts(column):
            words = words_of(t)
            held.append([known.get(w, OTHER) for w in words])
            size += len(words)
            if size >= SHARD_WORDS:
                shard()
                size = 0
        if held:
            shard()
        for k, old in enumerate(earlier):
            if old.is_valid:
                o, (n, s, e, i) = old.as_py(), rows[k]
                spans = merged([*zip(o["starts"], o["ends"], strict=True), *zip(s, e, strict=True)])
                rows[k] = (n, [x for x, _ in spans], [x for _, x in spans], sorted({*o["items"], *i}))
        fields = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        return pa.StructArray.from_arrays([pa.array(f, k.type) for f, k in zip(fields, _ARROW, strict=True)], fields=list(_ARROW))

    return F.arrow_udf(scan, KIND).asNondeterministic()  # so that it runs once, however often it is read


def with_spans(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", name: str = "leak") -> DataFrame:
    """``df`` with a struct: the text's number of words, starts and ends (word numbers, end exclusive) of the spans that windows
    of benchmark items cover, and the ids, as sorted strings, of those items.

    Null and empty texts have no words. Items without id or without words are left out; repeated ids are one item. Repeated rows
    stay; a column called ``name`` is replaced. The driver holds one block of items (about PHRASE_WORDS words) at a time.
    """
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // (6 * PHRASE_WORDS)))
    out = df.withColumn(name, F.lit(None).cast(KIND))
    for k in range(n):
        block = tuple((r.i, r.t) for r in items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect())
        out = out.withColumn(name, _scanner(block)(F.col(text), F.col(name)))
        if k + 1 < n:
            out = stored(out, "leaks")
    return out


def removed(text: str | None, starts: list[int], ends: list[int]) -> str | None:
    """The text without the words of the spans, and without what stands between them; for callers that cut instead of drop."""
    if not text or not starts:
        return text
    data = text.encode("utf-8", "surrogatepass")
    flat = data.translate(_TABLE)
    import re

    places = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", flat)]
    out, at = [], 0
    for s, e in zip(starts, ends, strict=True):
        out.append(data[at : places[s][0]])
        at = places[e - 1][1]
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


#: The query over `documents` and `benchmark` in DuckDB's SQL.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
g AS (
  SELECT rid, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM p))),
h AS (SELECT rid, size, i, item_id FROM g JOIN p USING (size, gram)),
n AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS k FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT rid, item_id::VARCHAR AS x FROM h) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN t USING (rid)
"""
