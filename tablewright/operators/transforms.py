"""Fitting and applying the declared feature transforms.

Fitting runs a fixed number of passes whatever the number of columns: moments of the numeric ones, one
histogram of the discrete ones, one term pass per text column. Applying is column expressions and Spark ML
transformers on constants, so it needs no shuffle and is the same in batch, in streams and in training.
Vocabularies too large for constants stay tables and are joined.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from math import sqrt
from typing import Any

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.columns import as_category, as_flag, as_number, as_time, category_text, is_numeric, key_text, present, ref
from tablewright.functions.storage import cut_lineage
from tablewright.operators.stats import exact_medians, histogram, modes, moments, value_text
from tablewright.operators.text import MAX_TERMS, Vocabulary, fit_vocabularies, weigh
from tablewright.spec import FeatureSpec, TableSpec

CONSTANT_VOCABULARY = 100_000  # larger category sets are joined, not held as constants
CONSTANT_CHARS = 16_000_000  # and so are those whose texts are longer than this together
BROADCAST_VOCABULARY = 1_000_000  # up to here, and
BROADCAST_CHARS = 100_000_000  # up to here, the joined table goes to every task
HOT_CATEGORIES, HOT_CHARS = 1_000, 1_000  # commonest categories (and longest text) looked up as constants
SALTS = 4_096
TARGET = "__target__"
MISSING_TEXT, MISSING_NUMBER = "missing_value", 0  # fixed values: constant imputation


@dataclass
class Fitted:
    """What was learned about one feature (or, under ``TARGET``, about the labels)."""

    name: str
    kind: str
    fill: Any = None
    center: float = 0.0
    scale: float = 1.0
    categories: list[str] | None = None  # in code order; None if kept as a table
    size: int = 0
    chars: int = 0  # of all categories together
    hot: dict[str, int] = field(default_factory=dict)  # codes of the commonest categories kept as a table
    terms: list[str] = field(default_factory=list)
    documents: int = 0
    containing: list[int] = field(default_factory=list)

    @property
    def vocabulary(self) -> Vocabulary:
        return Vocabulary(self.terms, self.documents, self.containing)

    @property
    def block_names(self) -> list[str]:
        if self.kind == "onehot":
            if self.categories is None:
                return [f"{self.name}={i}" for i in range(self.size)]
            return [f"{self.name}={c}" for c in self.categories]
        if self.kind in ("count", "tfidf"):
            return [f"{self.name}:{t}" for t in self.terms]
        if self.kind == "components":
            return [f"{self.name}_{p}" for p in ("year", "month", "day", "dayofweek")]
        return [self.name]


# --------------------------------------------------------------------------------------------- fitting


def _discrete_value(df: DataFrame, f: FeatureSpec) -> Column:
    """What the histogram counts for a feature whose mode or categories are needed."""
    if f.type == "numeric":
        return as_number(df, f.name)
    if f.type == "datetime":
        return F.unix_micros(as_time(df, f.name))
    if f.type == "boolean":
        return as_flag(df, f.name)
    value = as_category(df, f.name)
    if f.imputation == "constant":
        return F.coalesce(value, F.lit(_constant(df, f)))
    return value


def _constant(df: DataFrame, f: FeatureSpec) -> Any:
    numeric = f.type == "numeric" or is_numeric(df.schema[f.name].dataType)
    return MISSING_NUMBER if numeric else MISSING_TEXT


def _needs_histogram(f: FeatureSpec) -> bool:
    return f.type in ("categorical", "datetime", "boolean") or (f.type == "numeric" and f.imputation == "most_frequent")


def fit_transforms(df: DataFrame, spec: TableSpec, with_target: bool = True, only: list[str] | None = None) -> FittedTable:
    """Learn every declared transform from the rows of ``df``."""
    features = [f for f in spec.features if only is None or f.name in only]
    absent = [f.name for f in features if f.name not in df.columns]
    if absent:
        raise ValueError(f"Missing columns in data: {', '.join(absent)}")
    fitted: dict[str, Fitted] = {}
    tables: dict[str, DataFrame] = {}

    discrete = {f.name: _discrete_value(df, f) for f in features if _needs_histogram(f)}
    classes = with_target and spec.target_name in df.columns and spec.target_type != "continuous"
    if classes:
        discrete[TARGET] = as_category(df, spec.target_name)
    common: dict[str, Any] = {}
    sizes: dict[str, int] = {}
    chars: dict[str, int] = {}
    vocabularies: dict[str, list[str]] = {}
    hot: dict[str, dict[str, int]] = {}
    if discrete:
        hist = histogram(df, discrete).persist()
        try:
            for r in modes(hist).collect():
                common[r.feature] = r.value
                sizes[r.feature], chars[r.feature] = r.distinct, r.chars
            coded = [f.name for f in features if f.type == "categorical"] + ([TARGET] if classes else [])
            coded = [c for c in coded if c in sizes]
            small = [c for c in coded if sizes[c] <= CONSTANT_VOCABULARY and chars[c] <= CONSTANT_CHARS]
            if small:
                rows = hist.where(F.col("feature").isin(small)).select("feature", "value", value_text().alias("t")).collect()
                for r in sorted(rows, key=lambda r: (r.feature, _order(r.value))):
                    vocabularies.setdefault(r.feature, []).append(r.t)
            for c in coded:
                if c not in small:
                    mine = hist.where(F.col("feature") == c)
                    tables[c] = _ranked(mine)
                    hot[c] = _hot_codes(mine, tables[c])
        finally:
            hist.unpersist()

    numbers = {f.name: as_number(df, f.name) for f in features if f.type == "numeric"}
    by_median = [n for n in numbers if spec.feature(n).imputation == "median"]
    stats = moments(df, numbers, sketch=by_median)
    for name, m in stats.items():
        if m.count == 0 and spec.feature(name).imputation != "constant":
            raise ValueError(f"Column '{name}' has no values to learn from")
    medians = exact_medians(df, {n: numbers[n] for n in by_median}, stats)

    written = [f for f in features if f.type == "text"]
    training = spec.training
    terms = fit_vocabularies(df, [ref(f.name).cast("string") for f in written], training.get("max_features", MAX_TERMS), training.get("min_df", 1)) if written else []
    terms_of = {f.name: v for f, v in zip(written, terms, strict=True)}
    for f in features:
        if f.type == "numeric":
            fitted[f.name] = _fit_number(f, stats[f.name], medians.get(f.name), common.get(f.name))
        elif f.type == "text":
            v = terms_of[f.name]
            fitted[f.name] = Fitted(f.name, f.kind, terms=v.terms, documents=v.documents, containing=v.containing)
        else:
            if f.name not in common:
                raise ValueError(f"Column '{f.name}' has no values to learn from")
            value = common[f.name]
            if f.type == "categorical":
                fill = _constant(df, f) if f.imputation == "constant" else _plain(value)
                fitted[f.name] = Fitted(
                    f.name,
                    f.kind,
                    fill=str(fill),
                    categories=vocabularies.get(f.name),
                    size=sizes[f.name],
                    chars=chars[f.name],
                    hot=hot.get(f.name, {}),
                )
            else:
                fitted[f.name] = Fitted(f.name, f.kind, fill=value.i)
    if classes:
        if TARGET not in sizes:
            raise ValueError(f"Target column '{spec.target_name}' has no values")
        fitted[TARGET] = Fitted(
            TARGET,
            "label",
            categories=vocabularies.get(TARGET),
            size=sizes[TARGET],
            chars=chars[TARGET],
            hot=hot.get(TARGET, {}),
        )
    return FittedTable(spec, fitted, tables, [f.name for f in features])


def _order(value) -> tuple:
    return tuple(x for x in (value.i, value.d, value.s) if x is not None)


def _plain(value) -> Any:
    """The text Spark gives the value, so that it equals ``category_text`` of the same value."""
    return value.i if value.i is not None else value.s if value.s is not None else _spark_double_text(value.d)


def _spark_double_text(x: float) -> str:
    return SparkSession.active().range(1).select(F.lit(x).cast("string")).first()[0]


def _ranked(hist: DataFrame) -> DataFrame:
    """(text, code) in value order for a vocabulary of any size: a range-partitioned sort, whose partitions a
    checkpoint fixes; a row's code is its place in its partition plus the sizes of the partitions before."""
    ordered = hist.select("value", value_text().alias("text")).orderBy("value").select("text")
    placed = cut_lineage(ordered).withColumn("id", F.monotonically_increasing_id())
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r.p: r["count"] for r in placed.groupBy(part.alias("p")).count().collect()}
    starts, total = [], 0
    for p in range(max(sizes) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), (part + 1).cast("int"))
    return placed.select("text", (start + place).alias("code"))


def _hot_codes(hist: DataFrame, codes: DataFrame) -> dict[str, int]:
    """The commonest categories with their codes."""
    short = hist.where(F.length(value_text()) <= HOT_CHARS)
    top = short.orderBy(F.desc("n"), "value").limit(HOT_CATEGORIES).select(value_text().alias("text"))
    return {r.text: r.code for r in codes.join(F.broadcast(top), "text").collect()}


def _fit_number(f: FeatureSpec, m, median: float | None, mode) -> Fitted:
    fill = {"mean": m.mean, "median": median, "most_frequent": mode.d if mode else None, "constant": float(MISSING_NUMBER)}[f.imputation]
    if m.count == 0:
        return Fitted(f.name, f.kind, fill=fill, center=fill)
    full = m.filled(fill)
    if f.kind == "standard":
        constant = full.low == full.high or not full.var
        return Fitted(f.name, f.kind, fill=fill, center=full.mean, scale=1.0 if constant else sqrt(full.var))
    if f.kind == "minmax":
        return Fitted(f.name, f.kind, fill=fill, center=full.low, scale=(full.high - full.low) or 1.0)
    return Fitted(f.name, f.kind, fill=fill)


# -------------------------------------------------------------------------------------------- applying


def _read(df: DataFrame, b: Fitted, value: Column, what: str) -> Column:
    """The value; a present one that does not read as its type stops the job rather than being imputed."""
    wrong = value.isNull() & present(df, b.name).isNotNull()
    stop = F.raise_error(F.concat(F.lit(f"Column '{b.name}' is not {what}: "), ref(b.name).cast("string")))
    return F.when(wrong, stop.cast(df.select(value.alias("v")).schema["v"].dataType)).otherwise(value)


def _expressions(df: DataFrame, b: Fitted) -> list[Column]:
    """The columns of a block that needs no dictionary; none for category codes and text."""
    if b.kind in ("numeric", "standard", "minmax"):
        value = F.coalesce(_read(df, b, as_number(df, b.name), "numeric"), F.lit(float(b.fill)))
        return [value if b.kind == "numeric" else (value - F.lit(b.center)) / F.lit(b.scale)]
    if b.kind == "boolean":
        return [F.coalesce(_read(df, b, as_flag(df, b.name), "boolean"), F.lit(int(b.fill))).cast("double")]
    if b.kind in ("components", "epoch"):
        time = F.coalesce(_read(df, b, as_time(df, b.name), "a date or time"), F.timestamp_micros(F.lit(int(b.fill))))
        if b.kind == "epoch":
            return [F.floor(F.unix_micros(time) / 1_000_000).cast("double")]
        return [p.cast("double") for p in (F.year(time), F.month(time), F.dayofmonth(time), F.weekday(time))]
    return []


@dataclass
class FittedTable:
    spec: TableSpec
    fitted: dict[str, Fitted]
    tables: dict[str, DataFrame]  # (text, code) of vocabularies kept as tables
    names: list[str]  # features covered, in declared order

    @property
    def blocks(self) -> list[Fitted]:
        return [self.fitted[n] for n in self.names]

    @property
    def feature_names(self) -> list[str]:
        return [n for b in self.blocks for n in b.block_names]

    @property
    def classes(self) -> list[str] | None:
        return self.fitted[TARGET].categories if TARGET in self.fitted else None

    @property
    def n_classes(self) -> int:
        return self.fitted[TARGET].size if TARGET in self.fitted else 0

    def unseen(self, df: DataFrame) -> DataFrame:
        """``df`` with ``unseen_labels``: names of the label-encoded columns whose value was never seen in fitting. Codes kept as a table
        are looked up by a join."""
        out, marks = df, []
        for i, b in enumerate(self.blocks):
            if b.kind != "label":
                continue
            text = F.coalesce(category_text(df, b.name), F.lit(b.fill))
            if b.categories is not None:
                strange = ~F.array_contains(F.array(*[F.lit(c) for c in b.categories]), text)
            else:
                out = self._join_codes(out.withColumn(f"__t_{i}", text), b, f"__t_{i}", f"__c_{i}")
                strange = F.col(f"__c_{i}").isNull()
            out = out.withColumn(f"__u_{i}", strange)
            marks.append(F.when(F.col(f"__u_{i}"), F.lit(f"unseen:{b.name}")))
        named = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
        return out.select(*[ref(c) for c in df.columns], named.alias("unseen_labels"))

    def scalars(self, df: DataFrame) -> dict[str, Column]:
        """Block columns that are plain expressions, by name: everything but category codes and text."""
        return {n: c for b in self.blocks for n, c in zip(b.block_names, _expressions(df, b), strict=False)}

    def encode(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """``df`` plus one ``__b_i`` column (number or vector) per block; and those columns' names in order."""
        absent = [b.name for b in self.blocks if b.name not in df.columns]
        if absent:
            raise ValueError(f"Missing columns in data: {', '.join(absent)}")
        new: dict[str, Column] = {}
        order: list[str] = []
        constant: list[tuple[Fitted, str, str]] = []
        joined: list[tuple[Fitted, str, str]] = []
        texts: list[tuple[Fitted, str]] = []
        for i, b in enumerate(self.blocks):
            name = f"__b_{i}"
            if b.kind in ("label", "onehot"):
                new[f"__t_{i}"] = F.coalesce(category_text(df, b.name), F.lit(b.fill))
                (constant if b.categories is not None else joined).append((b, f"__t_{i}", name))
                order.append(name)
            elif b.kind in ("count", "tfidf"):
                texts.append((b, name))
                order.append(name)
            else:
                for j, column in enumerate(_expressions(df, b)):
                    new[f"{name}_{j}"] = column
                    order.append(f"{name}_{j}")
        out = df.withColumns(new) if new else df
        for b, t, n in constant:
            code, unseen = (n, "error") if b.kind == "label" else (f"{n}_code", "keep")
            indexer = StringIndexerModel.from_labels(b.categories, inputCol=t, outputCol=code, handleInvalid=unseen)
            out = indexer.transform(out).withMetadata(code, {})  # a code is a number to the models
        for b, t, n in joined:
            out = self._join_codes(out, b, t, f"{n}_code")
            if b.kind == "onehot":
                out = out.withColumn(f"{n}_code", F.coalesce(f"{n}_code", F.lit(float(b.size))))
            else:
                stop = F.raise_error(F.concat(F.lit(f"Unseen label in '{b.name}': "), F.col(t)))
                out = out.withColumn(n, F.coalesce(F.col(f"{n}_code"), stop.cast("double"))).drop(f"{n}_code")
        hot = [(b, n) for b, _, n in constant + joined if b.kind == "onehot"]
        if hot:
            # Codes run to size (unseen); dropping that last one leaves exactly the known categories. The sizes
            # go in as column attributes, so fitting the encoder starts no job.
            known = [{"ml_attr": {"type": "nominal", "num_vals": b.size + 1}} for b, _ in hot]
            widest = df.sparkSession.range(0).select(
                *[F.lit(0.0).alias(f"{n}_code", metadata=m) for (_, n), m in zip(hot, known, strict=True)]
            )
            encoder = OneHotEncoder(inputCols=widest.columns, outputCols=[n for _, n in hot], dropLast=True)
            out = encoder.fit(widest).transform(out).drop(*widest.columns)
        for b, n in texts:
            out = weigh(out, ref(b.name).cast("string"), b.vocabulary, n, b.kind == "tfidf")
        return out.drop(*[t for _, t, _ in constant + joined]), order

    def label(self, df: DataFrame, name: str = "label") -> DataFrame:
        """Adds the numeric target: its value, or the rank of its class."""
        target = self.spec.target_name
        if TARGET not in self.fitted:
            return df.withColumn(name, as_number(df, target))
        b = self.fitted[TARGET]
        with_text = df.withColumn("__y", category_text(df, target))
        if b.categories is not None:
            indexer = StringIndexerModel.from_labels(b.categories, inputCol="__y", outputCol=name, handleInvalid="error")
            return indexer.transform(with_text).drop("__y").withMetadata(name, {})
        coded = self._join_codes(with_text, b, "__y", name)
        stop = F.raise_error(F.concat(F.lit("Unseen class: "), F.col("__y"))).cast("double")
        return coded.withColumn(name, F.coalesce(F.col(name), stop)).drop("__y")

    def _join_codes(self, df: DataFrame, b: Fitted, text: str, name: str) -> DataFrame:
        """Adds the code of ``text`` (NULL if unseen) from a vocabulary kept as a table.

        Beyond broadcast size the rows move by category. Rows of the commonest categories, of which one may be a
        third of the table, take their codes from constants instead and are spread over salts that match nothing.
        """
        codes = self.tables[b.name].select(F.col("text").alias("__k"), F.col("code").cast("double").alias(name))
        if b.size <= BROADCAST_VOCABULARY and b.chars <= BROADCAST_CHARS:
            return df.join(F.broadcast(codes), F.col(text) == F.col("__k"), "left").drop("__k")
        common = F.from_json(F.lit(json.dumps(b.hot, ensure_ascii=False)), "map<string,bigint>")
        salt = F.concat(F.lit("\u0000"), F.pmod(key_text(df, None).cast("long"), F.lit(SALTS)).cast("string"))
        spread = df.withColumn("__hot", F.try_element_at(common, F.col(text)).cast("double"))
        spread = spread.withColumn("__m", F.when(F.col("__hot").isNull(), F.col(text)).otherwise(salt))
        out = spread.join(codes, F.col("__m") == F.col("__k"), "left")
        return out.withColumn(name, F.coalesce("__hot", name)).drop("__hot", "__m", "__k")

    def transform(self, df: DataFrame, features: str = "features", label: str | None = None) -> DataFrame:
        """``df`` plus the feature vector and, if ``label`` is named, the numeric target. Parameters are applied,
        never refitted."""
        out, blocks = self.encode(df)
        out = VectorAssembler(inputCols=blocks, outputCol=features, handleInvalid="error").transform(out).drop(*blocks)
        return self.label(out, label) if label else out

    def original_label(self, df: DataFrame, code: str, name: str) -> DataFrame:
        """Adds the class a predicted code stands for."""
        b = self.fitted.get(TARGET)
        if b is None:
            return df.withColumn(name, F.col(code))
        if b.categories is not None:
            names = F.from_json(F.lit(json.dumps(b.categories, ensure_ascii=False)), "array<string>")
            return df.withColumn(name, F.try_element_at(names, (F.col(code) + 1).cast("int")))
        codes = self.tables[TARGET].select(F.col("text").alias(name), F.col("code").cast("double").alias("__code"))
        return df.join(codes, F.col(code) == F.col("__code"), "left").drop("__code")

    # ------------------------------------------------------------------------------------ storage

    def save(self, spark: SparkSession, path: str) -> None:
        """Parameters as a Parquet table (feature, document); large vocabularies as Parquet tables beside it."""
        rows = [("", json.dumps({"spec": self.spec.to_dict(), "names": self.names}))]
        rows += [(n, json.dumps(asdict(f), ensure_ascii=False)) for n, f in self.fitted.items()]
        spark.createDataFrame(rows, "feature string, document string").coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")
        for name, table in self.tables.items():
            table.withColumn("feature", F.lit(name)).write.mode("overwrite").parquet(f"{path}/vocabulary/{self._slot(name)}")

    def _slot(self, name: str) -> str:
        return str(sorted(self.fitted).index(name))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedTable:
        docs = {r.feature: json.loads(r.document) for r in spark.read.parquet(f"{path}/parameters").collect()}
        head = docs.pop("")
        out = cls(TableSpec.from_dict(head["spec"]), {n: Fitted(**d) for n, d in docs.items()}, {}, head["names"])
        for name, f in out.fitted.items():
            if f.kind in ("label", "onehot") and f.categories is None:
                out.tables[name] = spark.read.parquet(f"{path}/vocabulary/{out._slot(name)}").select("text", "code")
        return out

