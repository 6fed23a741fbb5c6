"""SentencePiece encoding by a batched Viterbi in numpy, and decoding.

A text becomes words (a space goes with the word after it; no piece of the model reaches from one word into the next).
New words are grouped by length, and all words of a length advance together, one character at a time: every substring's
hash is looked up among the hashes of the pieces, the best way to each prefix is a maximum over piece lengths, and the
length that gave it is the way back. Characters that no piece holds are given as bytes.

In a unigram model a way is worth the sum of its scores. In a model of byte-pair merges it is worth something only if no
merge could have crossed a cut: two neighbouring pieces are right if undoing their merges, the later one first, meets no
merge across the cut that would have come earlier. Exactly one piece of each prefix is right with the piece before it, so
the maximum is the library's own segmentation, without replaying merges word by word.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import struct_array, texts, worker_cache

SPACE = "▁"
CACHED_WORDS = 50_000  # of a generation; there are two
BUCKET_BITS = 19  # of the hash of a piece, by which the pieces are looked up
PAIR_BITS = 20  # of the table of neighbouring pieces
CELLS = 200_000  # substrings looked at together
TOGETHER = 1_000_000  # characters encoded at a time
LONG_WORD = 512  # characters from which a word of a merge model is merged by itself
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


class PieceModel:
    """The pieces of a model file, and the words met so far."""

    def __init__(self, path: str, merges: bool = True):
        """``merges``: whether the model was trained as byte-pair merges (their order is the order of the scores) or as a unigram model."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in plain]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("the model has pieces that hold several words")
        self.unknown = model.unk_id()
        self.bytes_id = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.longest = max(map(len, pieces))
        scores = np.array([model.get_score(i) for i in plain], np.float64)
        self.unknown_score = float(scores.min()) - 10
        hashes = np.array([self._hash_of(p) for p in pieces], np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have one hash")
        order = np.argsort(hashes * _SPREAD)
        self.keys, self.scores, self.ids = hashes[order], scores[order], np.array(plain, np.int64)[order]
        self.none = len(self.keys)  # the place of what is no piece
        bucket = (self.keys * _SPREAD) >> np.uint64(64 - BUCKET_BITS)
        self.first = np.full(1 << BUCKET_BITS, self.none, np.int32)  # of a bucket: the place of its first key
        self.first[bucket[::-1]] = np.arange(self.none, dtype=np.int32)[::-1]
        self.goes_on = np.append(bucket[1:] == bucket[:-1], False)  # whether the next key is in the same bucket
        breaks = "" if any("\n" in p for p in pieces) else "\n"  # no piece holds a line break: words end there too
        self.words = re.compile((r"\n|" if breaks else "") + rf" *[^ {breaks}]+| +").findall
        self.surface = surfaces(model)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the generation before; words met again come back from it
        self.inside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}  # two characters that no piece holds side by side are a cut
        self.id_at = np.append(self.ids, -1).astype(np.int32)
        self.merges = merges
        self.score_of = dict(zip(pieces, scores.tolist(), strict=True))
        self.id_of = dict(zip(pieces, plain, strict=True))
        if merges:
            self._undo([pieces[i] for i in order])

    def _undo(self, pieces: list[str]) -> None:
        """For each piece (in the order of the keys) the place of its last merge in the order of merges, and that merge's parts."""
        place = {p: k for k, p in enumerate(pieces)}
        by_score = np.argsort(-self.scores, kind="stable")
        self.rank = np.full(len(pieces) + 1, -1, np.int64)
        self.left, self.right = np.full(len(pieces) + 1, -1, np.int64), np.full(len(pieces) + 1, -1, np.int64)
        order = np.empty(len(pieces), np.int64)
        order[by_score] = np.arange(len(pieces))
        self.made = np.ones(len(pieces) + 1, bool)  # pieces that merging their own text gives; the last entry is an unknown character
        for p, k in place.items():
            if len(p) > 1:
                parts = self._merged(p, last=True)
                if parts is None:
                    self.made[k] = False
                else:
                    self.rank[k], self.left[k], self.right[k] = order[k], place[parts[0]], place[parts[1]]
        self.merge_rank = np.append(order, np.iinfo(np.int64).max)
        self.whole = np.where(self.made, np.arange(len(pieces) + 1), self.none).astype(np.int32)
        self.pairs = np.full(1 << PAIR_BITS, np.iinfo(np.uint64).max, np.uint64)
        length = np.array([len(p) for p in pieces] + [1], np.uint64)
        self.hash = np.append(self.keys, np.uint64(0))
        self.length_hash = length * _LENGTH
        self.raw = self.hash - self.length_hash
        power = np.ones(self.longest + 1, np.uint64)
        for m in range(1, self.longest + 1):
            power[m] = power[m - 1] * _BASE
        self.shift = power[length]

    def _merged(self, word: str, last: bool = False):
        """The word's characters merged, best score first, of equals the first place. With ``last``, the parts of the merge that
        made the whole word, or None if none did."""
        symbols: list[str | None] = list(word)
        before, after = list(range(-1, len(word) - 1)), [*range(1, len(word)), -1]
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (s := self.score_of.get(symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-s, i, j, len(symbols[i]) + len(symbols[j])))

        for i in range(len(word) - 1):
            offer(i)
        parts = None
        while heap:
            _, i, j, n = heapq.heappop(heap)
            if symbols[i] is None or after[i] != j or symbols[j] is None or len(symbols[i]) + len(symbols[j]) != n:
                continue
            parts = (symbols[i], symbols[j])
            symbols[i] += symbols[j]
            symbols[j] = None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        whole = [s for s in symbols if s is not None]
        return (parts if len(whole) == 1 else None) if last else whole

    def _neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the texts of pieces ``a`` and ``b`` side by side leaves the cut between them. Pairs met before are looked up in
        a table of fixed size, one pair a slot: the pair, and the answer in the lowest bit."""
        pair = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) << np.uint64(1)
        slot = (pair * _BASE) >> np.uint64(64 - PAIR_BITS)
        kept = self.pairs[slot] ^ pair
        right = kept == 1
        new = np.flatnonzero(kept > 1)
        if len(new):
            right[new] = found = self._uncrossed(a[new], b[new])
            self.pairs[slot[new]] = pair[new] | found.astype(np.uint64)
        return right

    def _uncrossed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        right, live = np.ones(len(a), bool), np.flatnonzero((a < self.none) & (b < self.none))
        a, b = a[live], b[live]
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            at = self._places(self.raw[a] * self.shift[b] + self.length_hash[a] + self.hash[b])
            crossed = self.merge_rank[at] < limit
            right[live[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = np.flatnonzero(~crossed & ((ra >= 0) | (rb >= 0)))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb  # undo the later merge; of one piece twice, the second
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return right

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """The places of hashes among the keys; ``none`` of those that are no piece's."""
        out = np.full(keys.size, self.none, np.int32)
        keys = keys.ravel()
        at = self.first[(keys * _SPREAD) >> np.uint64(64 - BUCKET_BITS)]
        left = np.flatnonzero(at != self.none)
        at, key = at[left], keys[left]
        while len(left):
            same = self.keys[at] == key
            out[left[same]] = at[same]
            more = np.flatnonzero(~same & self.goes_on[at])
            left, at, key = left[more], at[more] + 1, key[more]
        return out

    @staticmethod
    def _hash_of(piece: str) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in piece:
                h = h * _BASE + np.uint64(ord(c) + 1)
            return h + np.uint64(len(piece)) * _LENGTH

    def segment(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length (a row of code points each): ids in order of the text, -1 for an unknown character and for
        the places left over, and how many of a row count."""
        k, n = chars.shape
        most = min(self.longest, n)
        code = chars.T.astype(np.uint64) + np.uint64(1)
        h = np.zeros((n + 1, k), np.uint64)
        power = np.ones(most + 1, np.uint64)
        for j in range(n):
            h[j + 1] = h[j] * _BASE + code[j]
        for m in range(1, most + 1):
            power[m] = power[m - 1] * _BASE
        found = np.full((most + 1, n, k), self.none, np.int32)  # by length and first character
        for m in range(1, most + 1):
            at = self._places(h[m:] - h[:-m] * power[m] + np.uint64(m) * _LENGTH)
            found[m, : n - m + 1] = (self.whole[at] if self.merges else at).reshape(-1, k)
        back = self._ways_of_merges(found) if self.merges else self._ways_of_scores(found)
        out, count, at = np.full((k, n), -1, np.int32), np.zeros(k, np.int64), np.full(k, n)
        rows = np.arange(k)
        while len(rows):
            m = back[at[rows], rows].astype(np.int64)
            start = at[rows] - m
            count[rows] += 1
            out[rows, n - count[rows]] = self.id_at[found[m, start, rows]]
            at[rows] = start
            rows = rows[start > 0]
        return out, count

    def _ways_of_merges(self, found: np.ndarray) -> np.ndarray:
        """The length of the last piece of each prefix (a row; a column is a word): the piece that is right with the one before it."""
        most, n, k = found.shape[0] - 1, *found.shape[1:]
        fits = found != self.none
        fits[1] = True
        length, start, word = np.nonzero(fits)
        order = np.argsort((length + start).astype(np.int16), kind="stable")  # by end; the longest last: it wins among equals
        piece, length, start, word = found[fits][order], length[order], start[order], word[order]
        stops = np.cumsum(np.bincount(length + start, minlength=n + 1))
        back = np.zeros((n + 1, k), np.int16)
        tail = np.full((n + 1, k), self.none, np.int32)  # the last piece of each prefix
        for j in range(1, n + 1):
            i, e = stops[j - 1], stops[j]
            right = np.ones(e - i, bool)
            inner = i + np.searchsorted(length[i:e], j)  # before it: those with a piece before them
            right[: inner - i] = self._neighbours(tail[start[i:inner], word[i:inner]], piece[i:inner])
            of = i + np.flatnonzero(right)
            longest = min(most, j)
            back[j], tail[j] = longest, found[longest, j - longest]
            back[j, word[of]], tail[j, word[of]] = length[of], piece[of]
        return back

    def _ways_of_scores(self, found: np.ndarray) -> np.ndarray:
        """The length of the last piece of each prefix (a row; a column is a word) in the way of the highest sum of scores."""
        most, n, k = found.shape[0] - 1, *found.shape[1:]
        score = np.append(self.scores, -np.inf)[found]
        score[1][found[1] == self.none] = self.unknown_score
        back = np.zeros((n + 1, k), np.int16)
        best = np.zeros((n + 1, k))
        for j in range(1, n + 1):
            lengths = range(min(most, j), 0, -1)  # the longest first: it wins among equals
            options = np.stack([best[j - m] + score[m, j - m] for m in lengths])
            choice = options.argmax(axis=0)
            best[j] = options[choice, np.arange(k)]
            back[j] = lengths[0] - choice
        return back

    def _learn(self, words: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            if self.merges and (len(w) > LONG_WORD or w.startswith("  ") or w == " "):  # merges of spaces have one score, so their places count
                parts = self._merged(w.replace(" ", SPACE))
                ids = np.array([self.id_of.get(p, -1) for p in parts], np.int64)
                self.known[w] = self._with_bytes(w, ids) if (ids < 0).any() else ids.astype("<u4").tobytes()
            else:
                by_length.setdefault(len(w), []).append(w)
        for n, some in by_length.items():
            step = max(1, CELLS // (n * min(n, self.longest)))
            for a in range(0, len(some), step):
                part = some[a : a + step]
                chars = np.frombuffer("".join(part).replace(" ", SPACE).encode("utf-32-le"), "<u4").reshape(len(part), n)
                ids, count = self.segment(chars)
                used = np.arange(n)[None, :] >= n - count[:, None]
                strange = ((ids < 0) & used).any(axis=1)
                data, stops = ids[used].astype("<u4").tobytes(), (np.cumsum(count) * 4).tolist()
                for k, (w, i, j) in enumerate(zip(part, [0, *stops[:-1]], stops, strict=True)):
                    self.known[w] = self._with_bytes(w, ids[k, n - count[k] :]) if strange[k] else data[i:j]

    def _with_bytes(self, word: str, ids: np.ndarray) -> bytes:
        out, at = [], 0
        for i in ids.tolist():
            if i >= 0:
                out.append(i)
                at += len(self.surface[i].decode())
                continue
            data = word[at].encode("utf-8", "surrogatepass")
            out += [self.bytes_id[b] for b in data] if self.bytes_id else [self.unknown]
            at += 1
        return np.asarray(out, "<u4").tobytes()

    def encode(self, some: list[str | None]) -> list[bytes]:
        """The ids of several texts, each as little-endian unsigned 32-bit integers; none for null and empty texts."""
        split = [self.words(" " + t) if t else [] for t in some]
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*split).difference(known)
        if new:
            again = new.intersection(older)
            known.update([(w, older[w]) for w in again])
            new -= again
            cut = {w: (w[:-1], w[-1]) for w in new if len(w) > 1 and w[-1] in ".,;:!?" and w[-2:] not in self.inside and w[-2] != " "}
            self._learn(list({p for w in new for p in cut.get(w, (w,)) if p not in known}))
            known.update((w, known[a] + known[b]) for w, (a, b) in cut.items())
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        return decoded(self.surface, ids)


def surfaces(model) -> list[bytes]:
    """What each id of a library's model stands for."""
    n = model.get_piece_size()
    out = [b"" if model.is_control(i) else bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
    out[model.unk_id()] = " ⁇ ".encode()
    return out


def decoded(surface: list[bytes], ids: bytes) -> str:
    """The text of ids. The space that encoding put in front is taken off; a SPACE sign in the text comes back as a space."""
    data = b"".join(map(surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return data.removeprefix(b" ").decode("utf-8", "replace")


def piece_model(path: str, merges: bool = True) -> PieceModel:
    """The model of this Python worker; it serves one task after another."""

    def make() -> PieceModel:
        with np.errstate(over="ignore"):
            return PieceModel(path, merges)

    return worker_cache(("pieces", path, merges), make)


def _runs(column: pa.Array) -> Iterator[list]:
    """The values of a column, so many at a time that they have TOGETHER characters or bytes."""
    held, size = [], 0
    for t in texts(column):
        held.append(t)
        size += len(t or "")
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encoder(model: str, merges: bool):
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for some in _runs(column):  # each goes back by itself: a worker never holds the ids of a whole batch
                with np.errstate(over="ignore"):
                    ids = pa.array(piece_model(model, merges).encode(some), pa.binary())
                yield ids

    return encode


def with_ids(df: DataFrame, model: str, text: str = "text", name: str = "ids", merges: bool = True) -> DataFrame:
    """``df`` with the ids of every whole text, as binary of little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Repeated rows stay; a column called ``name`` is replaced.
    """

    return df.withColumn(name, F.arrow_udf(_encoder(model, merges), "binary").asNondeterministic()(F.col(text)))  # so that it runs once, however often it is read


def _surfaces_of(path: str) -> list[bytes]:
    import sentencepiece

    return surfaces(sentencepiece.SentencePieceProcessor(model_file=path))


def _decoder(model: str):
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for some in _runs(column):
                surface = worker_cache(("surfaces", model), lambda: _surfaces_of(model))
                yield pa.array([None if x is None else decoded(surface, x) for x in some], pa.string())

    return decode


def with_text(df: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; null ids give null."""
    return df.withColumn(name, F.arrow_udf(_decoder(model), "string").asNondeterministic()(F.col(ids)))


def _round_trip(path: str, merges: bool):
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.string())])

    def there_and_back(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for some in _runs(column):
                model = piece_model(path, merges)
                with np.errstate(over="ignore"):
                    ids = model.encode(some)
                yield struct_array([(x, model.decode(x)) for x in ids], kind)

    return there_and_back


def round_trip(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", merges: bool = True) -> DataFrame:
    """``df`` with the ids of every whole text and the text of those ids: what ``with_text`` gives after ``with_ids``.

    One Python step does both, so a task has one Python worker, and it keeps the model from one task to the next. In two steps a task has
    two workers, which change roles between tasks; each then drops the model or makes it anew and learns its words again.
    """
    both = F.arrow_udf(_round_trip(model, merges), "ids binary, decoded string").asNondeterministic()
    return df.withColumn(ids, both(F.col(text))).withColumns({ids: F.col(ids)["ids"], decoded: F.col(ids)["decoded"]})
