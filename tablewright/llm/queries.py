"""One query per corpus operator on the test tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import chat, fmindex, html, jaccard, licenses, minhash, pieces, pii, quality, ranking, runs, sharding, tokens
from tablewright.llm.base import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


N_SHARDS = 8


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in eight shards by their source, very uneven ones; they are moved to eight of equal bytes, written and read back."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.col("source")), F.lit(N_SHARDS))
    moved = sharding.reshard(docs.select("doc_id", "text", "source"), old, N_SHARDS, sharding.text_size(), [F.col("doc_id"), F.col("text")])
    folder = new_path(spark, "shards")
    sharding.write_shards(moved, folder)
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharding.read_shards(spark, folder, "doc_id long, text string, source string").select(
        "doc_id", sharding.text_size().alias("size"), F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_html")
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = table(spark, sf_dir, "pages").select("page_id", "url", html.extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op3_tokens")
def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through the token file and back."""
    back = tokens.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op4_chat")
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation with its repaired role and its piece of the rendered chat."""
    return chat.repaired(table(spark, sf_dir, "conversations"))


@query("op5_jaccard")
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their five-word shingles."""
    return jaccard.join_groups(table(spark, sf_dir, "documents"))


@query("op6_quality", quality.ORACLE)
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, and what the current policy makes of it."""
    df = quality.with_ledger(table(spark, sf_dir, "documents"))
    m = {c: F.col("ledger")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    return df.select("doc_id", *m.values(), quality.broken("base").alias("base_failed"), (~quality.broken("base") & ~quality.broken()).alias("kept"), F.col("ledger")["failed"].alias("failed_bits"))


@query("op7_decontaminate", fmindex.ORACLE)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that benchmark items cover, and those items."""
    found = fmindex.with_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    leak = F.col("leak")
    n_hit = F.aggregate(F.zip_with(leak["starts"], leak["ends"], lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", leak["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(leak["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(leak["items"], ","), 256).alias("items_sha256"), (F.size(leak["starts"]) > 0).alias("contaminated"),
    )


@query("op8_pieces")
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to ids of pieces and back."""
    model = tokenizer("piece_bpe_32k.model")
    back = pieces.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    text = F.coalesce(F.regexp_replace("text", pieces.SPACE, " "), F.lit(""))
    return back.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), (F.col("decoded") == text).alias("same_text"))


@query("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    found = licenses.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("licenses", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"), m["matched"].cast("string"), m["words"].cast("string")))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_found"), F.array_join(spans, ",").alias("spans"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans, and all spans with those that the trees add."""
    docs = table(spark, sf_dir, "documents")
    found = pii.with_spans(docs.select("doc_id", "text"), pii.fit(docs))
    base = F.col("pii")["base"]
    counts = [pii.count_of(base, k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("pii")["spans"]).alias("spans"))


@query("op11_minhash")
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their four-word shingles, and the one of each that is kept."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_ranking", ranking.ORACLE)
def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that rank highest for every benchmark item."""
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_runs")
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, after the words of one document in ten are made periodic from some place on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", runs.looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.with_runs(docs).select("doc_id", "runs.*").withColumn("best", runs.strongest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)
