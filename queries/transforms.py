"""Feature transforms, fitted on whole tables and applied to every row."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from queries.common import HOLED, feature, holed_orders, query, rnd, spec, sql_mode, table
from queries.sources import ASSEMBLED, LINE_SPEC, assembled
from tablewright.operators.transforms import fit_transforms
from tablewright.sources.files import spread


def _one(name: str, features: list[dict], columns: list[str], sql: str, digits: int = 6):
    """Fit the features on the holed orders and show their scalar blocks per row."""

    def run(spark, sf_dir):
        df = holed_orders(spark, sf_dir)
        fitted = fit_transforms(df, spec(features, ("price", "continuous")), with_target=False)
        out, _ = fitted.encode(df)
        blocks = [c for c in out.columns if c.startswith("__b_")]
        return out.select("o_orderkey", *[rnd(F.col(b).cast("double"), digits).alias(n) for b, n in zip(blocks, columns, strict=True)])

    query(name, sql)(run)


_one("impute_mean", [feature("price", "numeric"), feature("cust", "numeric")], ["price", "cust"],
    f"WITH {HOLED} SELECT o_orderkey, round(coalesce(price, avg(price) OVER ()), 6) + 0.0 AS price, round(coalesce(cust, avg(cust) OVER ()), 6) + 0.0 AS cust FROM holed")
_one("impute_median", [feature("price", "numeric", "impute_median"), feature("cust", "numeric", {"imputation": "median"})], ["price", "cust"],
    f"""WITH {HOLED}, m AS (SELECT quantile_cont(price, 0.5) AS p, quantile_cont(cust, 0.5) AS c FROM holed)
SELECT o_orderkey, round(coalesce(price, p), 6) + 0.0 AS price, round(coalesce(cust, c), 6) + 0.0 AS cust FROM holed, m""")  # fmt: skip
_one("impute_mode", [feature("cust", "numeric", "impute_mode")], ["cust"],
    f"WITH {HOLED} SELECT o_orderkey, coalesce(cust, {sql_mode('cust')}) + 0.0::DOUBLE AS cust FROM holed")
_one("impute_constant", [feature("price", "numeric", {"imputation": "constant"})], ["price"],
    f"WITH {HOLED} SELECT o_orderkey, round(coalesce(price, 0), 6) + 0.0 AS price FROM holed")
_one("scale_standard", [feature("price", "numeric", "scale"), feature("cust", "numeric", {"imputation": "median", "scaling": "standard"})], ["price", "cust"],
    f"""WITH {HOLED}, m AS (SELECT avg(price) AS p, quantile_cont(cust, 0.5) AS c FROM holed),
filled AS (SELECT o_orderkey, coalesce(price, p) AS price, coalesce(cust, c) AS cust FROM holed, m)
SELECT o_orderkey, round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) + 0.0 AS price,
round((cust - avg(cust) OVER ()) / stddev_pop(cust) OVER (), 6) + 0.0 AS cust FROM filled""")  # fmt: skip
_one("scale_minmax", [feature("price", "numeric", "minmax"), feature("cust", "numeric", {"imputation": "constant", "scaling": "minmax"})], ["price", "cust"],
    f"""WITH {HOLED}, filled AS (SELECT o_orderkey, coalesce(price, avg(price) OVER ()) AS price, coalesce(cust, 0) AS cust FROM holed)
SELECT o_orderkey, round((price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()), 6) + 0.0 AS price,
round((cust - min(cust) OVER ()) / (max(cust) OVER () - min(cust) OVER ()), 6) + 0.0 AS cust FROM filled""")  # fmt: skip
_one("encode_label", [feature("priority", "categorical", "label"), feature("cust", "categorical")], ["priority", "cust"],
    f"""WITH {HOLED}, filled AS (SELECT o_orderkey, coalesce(priority, {sql_mode('priority')}) AS priority, coalesce(cust, {sql_mode('cust')}) AS cust FROM holed)
SELECT o_orderkey, dense_rank() OVER (ORDER BY priority) - 1 + 0.0::DOUBLE AS priority, dense_rank() OVER (ORDER BY cust) - 1 + 0.0::DOUBLE AS cust FROM filled""")  # fmt: skip
_one("impute_categorical", [feature("status", "categorical", {"imputation": "constant"}), feature("cust", "categorical", {"imputation": "constant"})], ["status", "cust"],
    f"""WITH {HOLED}, filled AS (SELECT o_orderkey, coalesce(status, 'missing_value') AS status, coalesce(cust, 0) AS cust FROM holed)
SELECT o_orderkey, dense_rank() OVER (ORDER BY status) - 1 + 0.0::DOUBLE AS status, dense_rank() OVER (ORDER BY cust) - 1 + 0.0::DOUBLE AS cust FROM filled""")  # fmt: skip
_one("datetime_components", [feature("placed", "datetime", "components")], ["year", "month", "day", "dayofweek"],
    f"""WITH {HOLED}, filled AS (SELECT o_orderkey, coalesce(placed, {sql_mode('placed')}) AS placed FROM holed)
SELECT o_orderkey, year(placed) + 0.0::DOUBLE AS year, month(placed) + 0.0::DOUBLE AS month, day(placed) + 0.0::DOUBLE AS day, isodow(placed) - 1 + 0.0::DOUBLE AS dayofweek FROM filled""")  # fmt: skip
_one("datetime_fill", [feature("placed", "datetime", "timestamp")], ["placed"],
    f"WITH {HOLED} SELECT o_orderkey, floor(epoch(coalesce(placed, {sql_mode('placed')}))) + 0.0 AS placed FROM holed")
_one("encode_boolean", [feature("flag", "boolean")], ["flag"],
    f"""WITH {HOLED}, codes AS (SELECT o_orderkey, CASE WHEN flag IN ('True', '1') THEN 1 WHEN flag IN ('False', '0') THEN 0 END AS flag FROM holed)
SELECT o_orderkey, coalesce(flag, {sql_mode('flag', 'codes')}) + 0.0::DOUBLE AS flag FROM codes""")  # fmt: skip


@query("datetime_epoch", "SELECT event_id, floor(epoch(ts)) + 0.0 AS ts FROM events")
def datetime_epoch(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    fitted = fit_transforms(ev, spec([feature("ts", "datetime")], ("value", "continuous")), with_target=False)
    return ev.select("event_id", fitted.scalars(ev)["ts"].alias("ts"))


@query(
    "encode_onehot",
    f"""WITH {HOLED}, filled AS (SELECT o_orderkey, coalesce(priority, {sql_mode("priority")}) AS priority FROM holed),
cats AS (SELECT DISTINCT priority AS category FROM filled)
SELECT o_orderkey, category, CAST(priority = category AS INT) + 0.0::DOUBLE AS value FROM filled, cats""",
)
def encode_onehot(spark, sf_dir):
    df = holed_orders(spark, sf_dir)
    fitted = fit_transforms(df, spec([feature("priority", "categorical", "one-hot")]), with_target=False)
    names = F.array(*[F.lit(c) for c in fitted.fitted["priority"].categories])
    long = fitted.transform(df).select("o_orderkey", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return long.select("o_orderkey", F.get(names, F.col("i")).alias("category"), "value")


TERMS = r"""tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 ORDER BY sum(n) DESC, term LIMIT 100)"""
TEXT = feature("text", "text")


def _weights(spark, sf_dir, kind: str):
    docs = spread(table(spark, sf_dir, "documents"), 100)
    fitted = fit_transforms(docs, spec([feature("text", "text", kind)], ("n_chars", "continuous")), with_target=False)
    names = F.array(*[F.lit(t) for t in fitted.fitted["text"].terms])
    long = fitted.transform(docs).select("doc_id", F.posexplode(vector_to_array("features")).alias("i", "w"))
    return long.where("w != 0").select("doc_id", F.get(names, F.col("i")).alias("term"), rnd("w").alias("weight"))


@query("text_count", f"WITH {TERMS} SELECT doc_id, term, n + 0.0::DOUBLE AS weight FROM tf JOIN vocab USING (term)")
def text_count(spark, sf_dir):
    return _weights(spark, sf_dir, "count")


@query(
    "text_tfidf",
    f"""WITH {TERMS}, w AS (SELECT doc_id, term, n * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) + 0.0 AS weight FROM w""",
)
def text_tfidf(spark, sf_dir):
    return _weights(spark, sf_dir, "tfidf")


@query(
    "encode_target",
    f"WITH {HOLED} SELECT o_orderkey, status, dense_rank() OVER (ORDER BY status) - 1 + 0.0::DOUBLE AS label FROM holed WHERE status IS NOT NULL",
)
def encode_target(spark, sf_dir):
    from tablewright.operators.contract import drop_null_target

    wanted = spec([feature("price", "numeric")], ("status", "multiclass"))
    df = drop_null_target(holed_orders(spark, sf_dir), wanted)
    return fit_transforms(df, wanted).label(df).select("o_orderkey", "status", "label")


@query("assemble_features", ASSEMBLED)
def assemble_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return assembled(li, fit_transforms(li, LINE_SPEC))


@query(
    "transform_new_rows",
    """WITH seen AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderpriority != '5-LOW'),
f AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM seen), cats AS (SELECT DISTINCT o_orderpriority AS category FROM seen)
SELECT o_orderkey, round((o_totalprice - m) / s, 6) + 0.0 AS price, category, CAST(o_orderpriority = category AS INT) + 0.0::DOUBLE AS value FROM orders, f, cats
WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def transform_new_rows(spark, sf_dir):
    """Learn from earlier orders, apply to later ones, of which some have a priority never seen."""
    o = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    seen = o.where((F.col("o_orderdate") < cut) & (F.col("o_orderpriority") != "5-LOW"))
    wanted = spec([feature("o_totalprice", "numeric", "scale"), feature("o_orderpriority", "categorical", "one-hot")])
    fitted = fit_transforms(seen, wanted, with_target=False)
    names = F.array(*[F.lit(c) for c in fitted.fitted["o_orderpriority"].categories])
    rows = fitted.transform(o.where(F.col("o_orderdate") >= cut)).select("o_orderkey", vector_to_array("features").alias("v"))
    long = rows.select("o_orderkey", F.col("v")[0].alias("price"), F.posexplode(F.slice("v", 2, 1000)).alias("i", "value"))
    return long.select("o_orderkey", rnd("price").alias("price"), F.get(names, F.col("i")).alias("category"), "value")
