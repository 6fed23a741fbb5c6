"""From raw documents to piece ids: quality rules, near duplicates, benchmark passages, personal data, encoding.

Every stage takes (spark, docs, sf_dir) and returns rows; each is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import fmindex, jaccard, pieces, pii, quality
from tablewright.llm.base import stored
from tablewright.llm.queries import table, tokenizer

#: SQL cannot replay the trees of the fourth stage; tests hold run() against a brute-force version instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps. Documents without words go."""
    return quality.with_ledger(docs).where(~quality.broken()).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest id, once if its row is repeated.

    Documents without words are no copies of one another. Rows without an id stay.
    """
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    found = fmindex.with_spans(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size(F.col("leak")["starts"]) == 0).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of personal data replaced by their kind."""
    found = pii.with_spans(docs, pii.fit(docs)).withColumn("text", pii.redacted(F.col("text"), F.col("pii")["spans"]))
    n_chars = F.when(F.size(F.col("pii")["spans"]) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they read back as its text."""
    back = pieces.round_trip(docs.select("doc_id", "lang", "source", "text"), tokenizer("piece_bpe_32k.model"))
    text = F.coalesce(F.regexp_replace("text", pieces.SPACE, " "), F.lit(""))
    return back.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_ids"), "ids", (F.col("decoded") == text).alias("same_text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("piece_ids", piece_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
