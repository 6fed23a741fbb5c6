"""Ranked search over documents by the words they hold.

``index`` inverts the documents in shards: one row a shard, its distinct terms with their postings (document, occurrences). ``search``
reads the shards once for the document frequencies of a block of queries and once to rank. In a shard, a query's *short* posting
lists are summed term at a time into accumulators; the accumulators, ordered by document, then are one more list with bounds of its
own beside the *long* lists, and documents are ranked range by range: the lists' largest contributions in a range of documents
bound every score in it, ranges below the k-th best score are skipped, and within the others a document is given up as soon as the lists that
are left cannot lift it to that score. The best of earlier shards of a task raise the k-th best score for later ones. All
arithmetic on scores is in integers, so bounds are exact and nothing that belongs to the result is skipped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tablewright.llm.base import stored
from tablewright.llm.bytewords import TERM_BYTES, column_bytes, word_hashes

SHARD = 8 << 20  # bytes of text; a longer text is a shard of its own
RANGE = 128  # documents that one bound covers
SHORT = 16  # lists of at most one in so many documents are summed first
STEP = 8  # ranges, the most promising first, that are ranked before the k-th best score is looked at again
QUERY_BYTES = 4 << 20  # of the queries of a block

_INDEX = "ids array<long>, n_terms binary, terms binary, places binary, docs binary, times binary"


def _inverted(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    hashes, counts = word_hashes(*column_bytes(texts), TERM_BYTES)
    order = np.argsort(hashes, kind="stable")  # documents of a term stay in order
    h, d = hashes[order], np.repeat(np.arange(len(counts), dtype=np.int32), counts)[order]
    new_term = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    first = np.flatnonzero(new_term | np.concatenate([[True], d[1:] != d[:-1]])) if len(h) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(h))).astype(np.int32)
    heads = np.flatnonzero(new_term[first])
    columns = [counts.astype(np.int64), h[first][heads], np.append(heads, len(first)).astype(np.int64), d[first], times]
    listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.RecordBatch.from_arrays([listed, *[pa.array([c.tobytes()], pa.binary()) for c in columns]], ["ids", "n_terms", "terms", "places", "docs", "times"])


def index(docs: DataFrame, id: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """One row for each shard of documents, of about ``shard`` bytes of text; all documents and all their terms are in it. Rows stay in
    their partition; a partition holds whole shards. Texts are inverted whole."""

    def each(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            at = column_bytes(texts)[1]
            begin = 0
            while begin < len(ids):
                end = max(begin + 1, int(np.searchsorted(at, at[begin] + shard, side="right")) - 1)
                yield _inverted(ids.slice(begin, end - begin), texts.slice(begin, end - begin))
                begin = end

    return docs.select(F.col(id).cast("long"), F.col(text).cast("string")).mapInArrow(each, _INDEX)


@dataclass
class Statistics:
    """Documents with a term, and their terms with repeats."""

    n: int
    total: int


def statistics(indexed: DataFrame) -> Statistics:
    def each(batches):
        for b in batches:
            for x in b.column(0):
                n = np.frombuffer(x.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64())], ["n", "total"])

    got = indexed.select("n_terms").mapInArrow(each, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return Statistics(got.n or 0, got.total or 0)


def frequencies(indexed: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents that hold each of the (sorted, distinct) terms."""

    def each(batches):
        df = np.zeros(len(terms), np.int64)
        for b in batches:
            for t, p in zip(b.column(0), b.column(1), strict=True):
                have, places = np.frombuffer(t.as_buffer(), np.uint64), np.frombuffer(p.as_buffer(), np.int64)
                at, ok = _places(have, terms)
                df[ok] += (places[1:] - places[:-1])[at[ok]]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "df"])

    rows = indexed.select("terms", "places").mapInArrow(each, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(len(terms), np.int64)
    out[rows["term"].to_numpy(np.int64)] = rows["df"].to_numpy(np.int64)
    return out


def _places(have: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in a sorted array, and whether it does."""
    at = np.minimum(np.searchsorted(have, wanted), max(len(have) - 1, 0))
    return at, (have[at] == wanted if len(have) else np.zeros(len(wanted), bool))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


@dataclass
class Block:
    """Queries of one block: distinct terms, their weights, and each query's (place of term, occurrences)."""

    terms: np.ndarray
    weights: np.ndarray
    queries: list[list[tuple[int, int]]]


@dataclass
class _List:
    """Documents in order with what a term adds to their scores, and the most it adds in each range of documents."""

    docs: np.ndarray
    adds: np.ndarray
    most: np.ndarray

    @classmethod
    def of(cls, docs: np.ndarray, adds: np.ndarray, ranges: int) -> _List:
        most = np.zeros(ranges, np.int64)
        if len(docs):
            r = docs // RANGE
            heads = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            most[r[heads]] = np.maximum.reduceat(adds, heads)
        return cls(docs, adds, most)

    def at(self, docs: np.ndarray) -> np.ndarray:
        """What it adds to these documents: the list skips to each."""
        k = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[k] == docs, self.adds[k], 0)


class Best:
    """The k best (score, id) so far; equal scores by id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """A document below this score is not among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        ok = scores >= self.floor
        scores, ids = np.concatenate([self.scores, scores[ok]]), np.concatenate([self.ids, ids[ok]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Shard:
    def __init__(self, ids: pa.Array, n_terms, terms, places, docs, times, facts: Statistics, block: Block):
        self.able = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.length = 75 + 25 * n_terms * facts.n // max(facts.total, 1)
        self.places, self.docs, self.times, self.block = places, docs, times, block
        self.ranges = -(-len(self.ids) // RANGE)
        self.at, self.held = _places(terms, block.terms)
        self.lists: dict[int, _List] = {}

    def list_of(self, term: int) -> _List:
        if term not in self.lists:
            s = slice(self.places[self.at[term]], self.places[self.at[term] + 1])
            docs, tf = self.docs[s].astype(np.int64), self.times[s].astype(np.int64)
            adds = self.block.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * self.length[docs]))
            ok = self.able[docs] & (adds > 0)
            self.lists[term] = _List.of(docs[ok], adds[ok], self.ranges)
        return self.lists[term]

    def rank(self, query: list[tuple[int, int]], best: Best) -> None:
        lists = [(self.list_of(t), times) for t, times in query if self.held[t]]
        lists = [(x, times) for x, times in lists if len(x.docs)]
        edge = len(self.ids) // SHORT
        short, long = [x for x in lists if len(x[0].docs) <= edge], [x for x in lists if len(x[0].docs) > edge]
        # term at a time: the short lists become one
        if short:
            docs, adds = np.concatenate([x.docs for x, _ in short]), np.concatenate([x.adds * times for x, times in short])
            order = np.argsort(docs, kind="stable")
            docs, adds = docs[order], adds[order]
            heads = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
            summed = _List.of(docs[heads], np.add.reduceat(adds, heads), self.ranges)
            long.append((summed, 1))
        if not long:
            return
        floor = best.floor
        if short and len(summed.adds) >= best.k:  # sums so far are lower bounds of scores
            floor = max(floor, int(np.partition(summed.adds, len(summed.adds) - best.k)[len(summed.adds) - best.k]))
        # documents in turn, by ranges
        bounds = sum(x.most * times for x, times in long)
        ranges = np.flatnonzero(bounds >= floor)
        ranges = ranges[np.argsort(-bounds[ranges], kind="stable")]
        for at in range(0, len(ranges), STEP):
            floor = max(floor, best.floor)
            some = ranges[at : at + STEP]
            some = some[bounds[some] >= floor]
            if not len(some):
                return
            self._ranges(long, np.sort(some), floor, best)

    def _ranges(self, lists: list[tuple[_List, int]], ranges: np.ndarray, floor: int, best: Best) -> None:
        most = [int(x.most[ranges].max()) * times for x, times in lists]
        order = sorted(range(len(lists)), key=most.__getitem__)  # the last lists can lift a document to the floor, the first cannot
        below = np.cumsum([0, *[most[k] for k in order]]).tolist()
        needed = next((k for k in range(len(order)) if below[k + 1] >= floor), len(order))
        if needed == len(order):
            return
        found = []
        for k in order[needed:]:
            docs = lists[k][0].docs
            cuts = np.searchsorted(docs, np.stack([ranges, ranges + 1]) * RANGE)
            found += [docs[a:b] for a, b in cuts.T.tolist() if b > a]
        if not found:
            return
        docs = np.unique(np.concatenate(found))
        scores = np.zeros(len(docs), np.int64)
        for k in range(len(order) - 1, -1, -1):  # what is left below can add so much only
            x, times = lists[order[k]]
            scores += x.at(docs) * times
            hope = scores + below[k] >= floor
            docs, scores = docs[hope], scores[hope]
            if not len(docs):
                return
        best.add(scores, self.ids[docs])


def _blocks(queries: DataFrame) -> Iterator[list[tuple]]:
    """Queries with a text, some bytes of them at a time."""
    rows, size = [], 0
    for r in queries.where("text IS NOT NULL").toLocalIterator():
        rows.append((r.item, r.text))
        size += len(r.text.encode())
        if size >= QUERY_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _block(rows: list[tuple]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    hashes, counts = word_hashes(*column_bytes(pa.array([t for _, t in rows], pa.string())), TERM_BYTES)
    terms, at = np.unique(hashes, return_inverse=True)
    parts = np.split(at, np.cumsum(counts)[:-1])
    return terms, [sorted(Counter(p.tolist()).items()) for p in parts]


def search(indexed: DataFrame, queries: DataFrame, k: int = 20, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` documents of the highest score above 0 for every query row; equal scores by doc_id.

    Terms are stretches of ASCII letters and digits and of all characters beyond ASCII; A-Z are made small. A query without terms, and
    an empty index, give no rows. Repeated documents and repeated queries rank each by itself. Documents without an id count in
    the statistics but are not returned. Queries pass through the driver in blocks of bounded size; documents never do.
    """
    spark = indexed.sparkSession
    facts = statistics(indexed)
    asked = queries.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    kind = asked.schema["item"].dataType
    schema = StructType([StructField("query", IntegerType()), StructField(item, kind), StructField("doc_id", LongType()), StructField("score", LongType())])
    empty = spark.createDataFrame([], StructType([StructField(item, kind), StructField("rank", IntegerType()), StructField("doc_id", LongType()), StructField("score", LongType())]))
    results = [empty]
    for rows in _blocks(asked):
        terms, wanted = _block(rows)
        df = frequencies(indexed, terms)
        block = Block(terms, np.array([weight(facts.n, d) for d in df.tolist()], np.int64), wanted)
        names, arrow = [i for i, _ in rows], to_arrow_type(kind)

        def each(batches, block=block, names=names, arrow=arrow):
            best = [Best(k) for _ in block.queries]
            for b in batches:
                for r in range(b.num_rows):
                    kinds = (np.int64, np.uint64, np.int64, np.int32, np.int32)
                    parts = [np.frombuffer(c[r].as_buffer(), t) for c, t in zip(b.columns[1:], kinds, strict=True)]
                    shard = Shard(b.column(0)[r].values, *parts, facts, block)
                    for q, own in zip(block.queries, best, strict=True):
                        shard.rank(q, own)
            of = np.repeat(np.arange(len(best), dtype=np.int32), [len(x.ids) for x in best])
            columns = [pa.array(of), pa.array([names[q] for q in of.tolist()], arrow), pa.array(np.concatenate([x.ids for x in best])), pa.array(np.concatenate([x.scores for x in best]))]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

        ranked = indexed.mapInArrow(each, schema)
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        results.append(ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(item, "rank", "doc_id", "score"))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def ranked(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``search`` over a fresh index of ``docs``, kept in the shared folder."""
    return search(stored(index(docs), "search-index"), queries, k)


#: The same rows by SQL: all documents that share a term with an item are scored.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
facts AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS total FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, facts),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY item_id, term
),
scored AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), facts GROUP BY item_id, doc_id
),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
