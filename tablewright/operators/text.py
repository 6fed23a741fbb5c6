"""Term weights: vocabularies from heavy-hitter summaries, weighting by Spark ML transformers without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import tokens
from tablewright.functions.storage import cut_lineage

MAX_TERMS = 100  # fixed value: default vocabulary size
MOST_RECOUNTED = 100_000  # candidates of a column that one recount takes
ATTEMPTS = 2  # with summaries, the second eight times as large
TOGETHER = 1 << 18  # terms of a batch that a task looks at together


@dataclass(frozen=True)
class Vocabulary:
    terms: list[str]  # alphabetical
    documents: int
    containing: list[int]  # documents that hold each term

    @property
    def idf(self) -> list[float]:
        return [log((1 + self.documents) / (1 + d)) + 1 for d in self.containing]


SUMMARY_TERMS = 20_000  # counters that a task keeps for a text column, at the least
SUMMARY_SHARE = 100  # and so many for each term that is asked for


@dataclass
class Summary:
    """Counts of the commonest terms seen so far (Misra and Gries, 1982). A count is too low by ``error`` at most, and so is the 0 of a
    term that is not held. Summaries of parts add up to one of the whole, their errors too."""

    counts: dict[str, int]
    error: int = 0

    def add(self, terms: pa.Array, most: int) -> None:
        held = self.counts
        for term, n in zip(*(c.to_pylist() for c in terms.value_counts().flatten()), strict=True):
            held[term] = held.get(term, 0) + n
        if len(held) > 2 * most:
            cut = sorted(held.values(), reverse=True)[most]
            self.counts = {t: n - cut for t, n in held.items() if n > cut}
            self.error += cut


def in_runs(texts: pa.ListArray, most: int) -> Iterator[pa.ListArray]:
    """The texts' terms in runs of whole texts with ``most`` terms at most, but for a longer text, which is a run by itself. What a task
    makes of a run is small beside the batch, however many texts Spark sends together."""
    ends = texts.offsets.to_numpy()
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield texts.slice(at, end - at)
        at = end


def _summaries(df: DataFrame, texts: Sequence[Column], most: int) -> tuple[DataFrame, list[int], list[int]]:
    """(column, term, n) of every column's summary, kept, with each column's error and the number of its terms."""
    columns = len(texts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Summary({}) for _ in range(columns)]
        for b in batches:
            for k, s in enumerate(held):
                terms = b.column(k).flatten()
                for at in range(0, len(terms), TOGETHER):
                    s.add(terms.slice(at, TOGETHER), most)
        for k, s in enumerate(held):
            terms = [None, *s.counts]  # the null carries the error
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(terms), pa.int32()), pa.array(terms, pa.string()), pa.array([s.error, *s.counts.values()], pa.int64())], ["column", "term", "n"])

    parts = df.select(*[tokens(t).alias(f"t{k}") for k, t in enumerate(texts)]).mapInArrow(each, "column int, term string, n long")
    whole = cut_lineage(parts.groupBy("column", "term").agg(F.sum("n").alias("n")))
    errors, sizes = [0] * len(texts), [0] * len(texts)
    for r in whole.groupBy("column").agg(F.sum(F.when(F.col("term").isNull(), F.col("n"))).alias("error"), F.count("term").alias("size")).collect():
        errors[r.column], sizes[r.column] = r.error, r["size"]
    return whole.where("term IS NOT NULL"), errors, sizes


def _recounted(df: DataFrame, texts: Sequence[Column], wanted: Sequence[Sequence[str]]) -> tuple[list[dict[str, tuple[int, int]]], int]:
    """Of every column's wanted terms, how often each occurs and in how many texts; and the number of texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 0
        totals, within = [np.zeros(len(w), np.int64) for w in wanted], [np.zeros(len(w), np.int64) for w in wanted]
        sets = [pa.array(w, pa.string()) for w in wanted]
        for b in batches:
            rows += b.num_rows
            for k, w in enumerate(sets):
                if not len(w):
                    continue
                for terms in in_runs(b.column(k), TOGETHER):
                    at = pc.index_in(terms.flatten(), w)
                    owner = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
                    hit = at.is_valid().to_numpy(zero_copy_only=False)
                    place = at.fill_null(0).to_numpy(zero_copy_only=False)[hit].astype(np.int64)
                    totals[k] += np.bincount(place, minlength=len(w))
                    within[k] += np.bincount(np.unique(owner[hit] * len(w) + place) % len(w), minlength=len(w))
        found = [(k, i, int(totals[k][i]), int(within[k][i])) for k in range(len(sets)) for i in np.flatnonzero(totals[k]).tolist()]
        columns = list(zip(*[(-1, 0, rows, 0), *found], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["column", "at", "total", "containing"])

    parts = df.select(*[tokens(t).alias(f"t{k}") for k, t in enumerate(texts)]).mapInArrow(each, "column int, at int, total long, containing long")
    out: list[dict[str, tuple[int, int]]] = [{} for _ in texts]
    documents = 0
    for r in parts.groupBy("column", "at").agg(F.sum("total").alias("total"), F.sum("containing").alias("containing")).collect():
        if r.column < 0:
            documents = r.total
        else:
            out[r.column][wanted[r.column][r["at"]]] = r.total, r.containing
    return out, documents


def term_counts(df: DataFrame, text: Column) -> DataFrame:
    """(term, total, containing) over all texts. Each text is tokenised once and adds its terms' counts to the
    task's partial sums, so documents are never regrouped and a very common term is one row per task."""
    words = F.col("words")
    all_words = F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(1).alias("t"), F.lit(0).alias("d")))
    each_once = F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("term"), F.lit(0).alias("t"), F.lit(1).alias("d")))
    return (
        df.select(tokens(text).alias("words"))
        .select(F.explode(F.concat(all_words, each_once)).alias("x"))
        .groupBy("x.term")
        .agg(F.sum("x.t").alias("total"), F.sum("x.d").alias("containing"))
    )


def _exactly(df: DataFrame, text: Column, max_features: int, min_df: int) -> list[tuple[int, str, int]]:
    """The highest terms by counting all: what is left where summaries prove nothing (nearly all terms are equally common, or nearly
    all common ones are in too few texts)."""
    counts = term_counts(df, text).where(F.col("containing") >= min_df)
    return [(-r.total, r.term, r.containing) for r in counts.orderBy(F.desc("total"), "term").limit(max_features).collect()]


def fit_vocabularies(df: DataFrame, texts: Sequence[Column], max_features: int = MAX_TERMS, min_df: int = 1) -> list[Vocabulary]:
    """For every text column the ``max_features`` terms with the highest total count, ties to the smaller term.

    Two passes for all columns together: bounded summaries of the tasks give every term that may be among the highest, an exact
    recount of those decides. The cut is proven if no other term can reach the last one's count; where it is not, larger summaries follow, and
    then a count of all terms. Otherwise the vocabulary is never shuffled.
    """
    out: list[Vocabulary | None] = [None] * len(texts)
    documents = 0
    for attempt in range(ATTEMPTS):
        open_ = [k for k, v in enumerate(out) if v is None]
        if not open_:
            break
        some = [texts[k] for k in open_]
        held, errors, sizes = _summaries(df, some, max(SUMMARY_TERMS, SUMMARY_SHARE * max_features) * 8**attempt)
        wanted: list[list[str]] = []
        rest: list[int] = []  # the most that a term which is not recounted can have
        for k, (error, size) in enumerate(zip(errors, sizes, strict=True)):
            ordered = held.where(F.col("column") == k).orderBy(F.desc("n"), "term")
            rows = ordered.limit(4 * max_features * 8**attempt + 1).collect()  # more than asked for: terms of too few texts go
            if rows and size > len(rows):
                low = rows[max_features - 1].n - error
                if low < rows[-1].n:  # those that may reach the cut
                    rows = ordered.where(F.col("n") >= low).limit(MOST_RECOUNTED).collect()
            wanted.append([r.term for r in rows])
            rest.append(error if len(rows) == size else error + rows[-1].n)
        counts, documents = _recounted(df, some, wanted)
        for k, found in enumerate(counts):
            kept = sorted((-total, term, within) for term, (total, within) in found.items() if within >= min_df)[:max_features]
            if not rest[k] or len(kept) == max_features and -kept[-1][0] > rest[k]:
                out[open_[k]] = _vocabulary(kept, documents)
    return [v or _vocabulary(_exactly(df, t, max_features, min_df), documents) for v, t in zip(out, texts, strict=True)]


def _vocabulary(kept: list[tuple[int, str, int]], documents: int) -> Vocabulary:
    if not kept:
        raise ValueError("empty vocabulary: no text holds a token of two or more characters")
    kept = sorted(kept, key=lambda r: r[1])
    return Vocabulary([t for _, t, _ in kept], documents, [d for _, _, d in kept])


def fit_vocabulary(df: DataFrame, text: Column, max_features: int = MAX_TERMS, min_df: int = 1) -> Vocabulary:
    return fit_vocabularies(df, [text], max_features, min_df)[0]


def weigh(df: DataFrame, text: Column, vocabulary: Vocabulary, output: str, tfidf: bool) -> DataFrame:
    """Adds a sparse vector over the vocabulary: counts, or tf * idf scaled to length 1. A text without any
    of the terms gives a zero vector."""
    words = f"__words_{output}"
    counted = CountVectorizerModel.from_vocabulary(
        vocabulary.terms, inputCol=words, outputCol=f"__n_{output}" if tfidf else output
    ).transform(df.withColumn(words, tokens(text)))
    if not tfidf:
        return counted.drop(words)
    product = ElementwiseProduct(scalingVec=vocabulary.idf, inputCol=f"__n_{output}", outputCol=f"__w_{output}")
    unit = Normalizer(p=2.0, inputCol=f"__w_{output}", outputCol=output)
    return unit.transform(product.transform(counted)).drop(words, f"__n_{output}", f"__w_{output}")
