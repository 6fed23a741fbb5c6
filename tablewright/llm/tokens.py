"""Token ids of documents in a compact binary format with one dictionary for all of them.

A file holds *segments*: self-contained byte strings of up to ``SEGMENT_BYTES``. A segment starts with the hash of the
zstandard dictionary and an index (document id, where its frame starts, how many ids it holds); then follows one
frame per document. A short document is read by its index entry alone: one slice and one small frame, nothing around
it is decompressed. Spark's Parquet writer carries the segments, so files appear whole or not at all, on any store.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import new_path, worker_cache

END_ID = 1
MAGIC = b"TWTK\x01"
SEGMENT_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCUMENTS, SAMPLE_TEXT_BYTES = 1000, 32 << 10  # the dictionary is fitted on so many documents of at most this size
CACHED_WORDS = 1_500_000
TOGETHER = 256  # texts tokenised at a time

SEGMENT_SCHEMA = "part int, seq int, first_doc long, last_doc long, n_docs int, ids_before long, n_ids long, body binary"


#: Between an ASCII letter or digit and another ASCII sign the tokenizer's splitter always cuts. Beside other characters it may not:
#: lower-casing can give a mark that goes with the sign behind it, and Unicode tables differ.
_CUTS = re.compile(r"(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])|(?<=[!-/:-@\[-`{-~])(?=[A-Za-z0-9])")
#: Words where that is not so plain: apostrophes begin contractions, ``<|`` special tokens, and Python knows more white space.
_WHOLE = re.compile(r"'|<\||\s")


class WordCache:
    """Ids of a text put together from the ids of its words, and those from their pieces.

    The tokenizer's normaliser and splitter never look across white space, nor from an ASCII letter to an ASCII sign beside it, so a
    text's ids are those of its pieces in order. Words and pieces repeat; each is tokenised once while the cache holds it. The cache
    is emptied when it is full, so memory is bounded.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.known = tokenizer, {}
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    @staticmethod
    def words(text: str | None) -> list[bytes]:
        """Words between ASCII white space, A-Z lowered (the tokenizer lowers the rest itself) unless special tokens may occur."""
        data = text.encode() if text else b""
        return data.split() if b"<|" in data else data.lower().split()

    @staticmethod
    def pieces(word: bytes) -> list[bytes]:
        core = word.rstrip(b".,;:!?")
        if core.isalpha():  # ASCII letters and nothing else, the usual case
            return [core, word[len(core) :]] if len(core) < len(word) else [word]
        text = word.decode()
        if text.isalpha() or _WHOLE.search(text):
            return [word]
        return [p.encode() for p in _CUTS.split(text)]

    def _one_by_one(self, pieces: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        self.known.update((w, np.asarray(e.ids, "<u4").tobytes()) for w, e in zip(pieces, found, strict=True))

    def _learn_pieces(self, pieces: list[bytes]) -> None:
        """Runs of letters are one token group each, whose last token ends a word: many are tokenised as one text and cut there."""
        letters, others = [], []
        for w in pieces:
            (letters if w.isalpha() or w.decode().isalpha() else others).append(w)
        for at in range(0, len(letters), 4096):
            some = letters[at : at + 4096]
            ids = np.asarray(self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) != len(some):  # a letter whose lower case is more than a letter
                self._one_by_one(some)
                continue
            data = ids.tobytes()
            self.known.update((w, data[i:j]) for w, i, j in zip(some, [0, *stops[:-1]], stops, strict=True))
        if others:
            self._one_by_one(others)

    def serialized(self, some: list[str | None]) -> list[bytes]:
        """The ids of several texts, each as little-endian unsigned 32-bit integers without an end id."""
        known = self.known
        split = [self.words(t) for t in some]
        if len(known) > CACHED_WORDS:
            known.clear()
        new = set().union(*split).difference(known)
        if new:
            parts = {w: self.pieces(w) for w in new}
            self._learn_pieces([p for p in {p for x in parts.values() for p in x} if p not in known])
            known.update((w, b"".join([known[p] for p in x])) for w, x in parts.items() if len(x) != 1)
        return [b"".join(map(known.__getitem__, words)) for words in split]


def tokenizer_cache(path: str) -> WordCache:
    """The cache of this Python worker; it serves one task after another."""

    def make() -> WordCache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task one core
        from tokenizers import Tokenizer

        return WordCache(Tokenizer.from_file(path))

    return worker_cache(("tokens", path), make)


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:16]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=True)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def pack(documents: list[tuple[int | None, bytes, int]], dictionary: bytes) -> bytes:
    """A segment of (document id, frame, number of ids)."""
    n = len(documents)
    ids = np.array([0 if d is None else d for d, _, _ in documents], "<i8")
    null = np.array([d is None for d, _, _ in documents], "u1")
    offsets = np.zeros(n + 1, "<u8")
    np.cumsum([len(f) for _, f, _ in documents], out=offsets[1:])
    counts = np.array([c for _, _, c in documents], "<u8")
    head = MAGIC + dictionary_hash(dictionary) + struct.pack("<I", n)
    return b"".join([head, ids.tobytes(), null.tobytes(), offsets.tobytes(), counts.tobytes(), *[f for _, f, _ in documents]])


class Segment:
    """Reads a packed segment; frames are only decompressed when asked for."""

    def __init__(self, body: bytes, dictionary: bytes):
        m = len(MAGIC)
        if body[:m] != MAGIC or body[m : m + 16] != dictionary_hash(dictionary):
            raise ValueError("not a segment, or written with another dictionary")
        (self.n,) = struct.unpack_from("<I", body, m + 16)
        at = m + 20
        self.ids = np.frombuffer(body, "<i8", self.n, at)
        self.null = np.frombuffer(body, "u1", self.n, at := at + 8 * self.n)
        self.offsets = np.frombuffer(body, "<u8", self.n + 1, at := at + self.n)
        self.counts = np.frombuffer(body, "<u8", self.n, at := at + 8 * (self.n + 1))
        self.body, self.at, self.unpacker = body, at + 8 * self.n, _decompressor(dictionary)

    def document(self, i: int) -> bytes:
        """The ids of the i-th document as little-endian unsigned 32-bit integers."""
        frame = self.body[self.at + int(self.offsets[i]) : self.at + int(self.offsets[i + 1])]
        return self.unpacker.decompress(frame)

    def find(self, doc_id: int) -> bytes | None:
        """Short-document access by id; documents of a segment are in ascending order of their ids."""
        first = int(np.count_nonzero(self.null))  # rows without an id stand first
        i = first + int(np.searchsorted(self.ids[first:], doc_id))
        return self.document(i) if i < self.n and self.ids[i] == doc_id else None


def train_dictionary(df: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> bytes:
    """The shared dictionary, fitted in one task on a bounded sample: the SAMPLE_DOCUMENTS texts with the lowest hashes
    among those of at most SAMPLE_TEXT_BYTES. Empty if there are too few texts to fit one."""
    order = F.xxhash64(F.col(id), F.col(text))
    few = df.where(F.octet_length(text) <= SAMPLE_TEXT_BYTES).select(order.alias("h"), F.col(text).alias("t")).orderBy("h").limit(SAMPLE_DOCUMENTS)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokenizer_cache(tokenizer)
        samples = [x + END_ID.to_bytes(4, "little") for b in batches for x in cache.serialized(b.column(1).to_pylist())]
        try:
            found = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 10 else b""
        except zstandard.ZstdError:  # too little to learn from
            found = b""
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["d"])

    rows = few.mapInArrow(fit, "d binary").where(F.length("d") > 0).take(1)
    return bytes(rows[0].d) if rows else b""


def write_tokens(df: DataFrame, folder: str, tokenizer: str, id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, add the end id and write segments in ascending order of ``id`` under ``folder``.

    A null or empty text is a document of the end id alone. Rows without an id come first, rows with equal ids follow
    one another in the order of a hash of their texts; other columns are not written.
    """
    spark = df.sparkSession
    dictionary = train_dictionary(df, tokenizer, id, text)
    spark.createDataFrame([(bytearray(dictionary), dictionary_hash(dictionary).hex())], "dictionary binary, hash string").coalesce(1).write.parquet(f"{folder}/dictionary")
    rows = df.select(F.col(id).cast("long").alias("i"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.col(text).alias("t"))
    ordered = rows.repartitionByRange("i", "h").sortWithinPartitions("i", "h")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, packer, end = tokenizer_cache(tokenizer), _compressor(dictionary), END_ID.to_bytes(4, "little")
        part, seq, before, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("n_docs", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary())])

        def out() -> pa.RecordBatch:
            nonlocal seq, before, held, size
            n = sum(c for _, _, c in held)
            row = [part, seq, held[0][0], held[-1][0], len(held), before, n, pack(held, dictionary)]
            seq, before, held, size = seq + 1, before + n, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for b in (whole.slice(k, TOGETHER) for whole in batches for k in range(0, whole.num_rows, TOGETHER)):
            for i, ids in zip(b.column(0), cache.serialized(b.column(2).to_pylist()), strict=True):
                frame = packer.compress(ids + end)
                held.append((i.as_py(), frame, len(ids) // 4 + 1))
                size += len(frame) + 25
                if size >= SEGMENT_BYTES:
                    yield out()
        if held:
            yield out()

    ordered.mapInArrow(encode, SEGMENT_SCHEMA).write.parquet(f"{folder}/segments")


def read_dictionary(spark, folder: str) -> bytes:
    """The dictionary of a folder (at most DICTIONARY_BYTES), checked against its hash."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if dictionary_hash(bytes(row.dictionary)).hex() != row.hash:
        raise ValueError("the dictionary does not match its hash")
    return bytes(row.dictionary)


def read_tokens(spark, folder: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32 bit)."""
    dictionary = read_dictionary(spark, folder)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments")
    sums = sorted((r.part, r.n) for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # one per writing task
    offsets, total = [], 0
    for part, n in sums:
        offsets.append((part, total))
        total += n
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, offset long"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for body, first in zip(b.column(0), b.column(1), strict=True):
                s = Segment(body.as_py(), dictionary)
                ids = [s.document(i) for i in range(s.n)]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                begin = first.as_py() + np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
                docs = pa.array(s.ids.astype(np.int64), mask=s.null.astype(bool))
                yield pa.RecordBatch.from_arrays([docs, pa.array(begin), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    placed = segments.join(starts, "part").select("body", (F.col("offset") + F.col("ids_before")).alias("first"))
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(df: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``df`` into a new folder of the shared store and read it back."""
    folder = new_path(df.sparkSession, "tokens")
    write_tokens(df, folder, tokenizer, id, text)
    return read_tokens(df.sparkSession, folder)
