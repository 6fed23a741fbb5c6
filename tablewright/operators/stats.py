"""The passes over the data that fitting and profiling share: moments, value counts, exact quantiles."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A built-in exact percentile holds every distinct value in one buffer; beyond this many, narrow first.
EXACT_BUFFER_VALUES = 100_000


@dataclass(frozen=True)
class Moments:
    rows: int
    count: int
    mean: float | None
    var: float | None
    low: float | None
    high: float | None
    distinct: int | None = None  # a sketch's estimate, if asked for

    def filled(self, fill: float) -> Moments:
        """The moments after every missing value is replaced by ``fill``, without another pass."""
        missing = self.rows - self.count
        if missing == 0:
            return self
        mean = (self.count * self.mean + missing * fill) / self.rows
        spread = self.count * (self.var + (self.mean - mean) ** 2) + missing * (fill - mean) ** 2
        return Moments(
            self.rows, self.rows, mean, spread / self.rows, min(self.low, fill), max(self.high, fill), self.distinct
        )


def moments(df: DataFrame, columns: Mapping[str, Column], sketch: Collection[str] = ()) -> dict[str, Moments]:
    """Count, mean, population variance and range of each column, and of those in ``sketch`` roughly the number
    of distinct values: one pass."""
    if not columns:
        return {}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, (name, col) in enumerate(columns.items()):
        distinct = F.approx_count_distinct(col) if name in sketch else F.lit(None)
        aggs += [
            F.count(col).alias(f"n{i}"),
            F.avg(col).alias(f"mean{i}"),
            F.var_pop(col).alias(f"var{i}"),
            F.min(col).alias(f"low{i}"),
            F.max(col).alias(f"high{i}"),
            distinct.alias(f"distinct{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        name: Moments(row["rows"], *(row[f"{k}{i}"] for k in ("n", "mean", "var", "low", "high", "distinct")))
        for i, name in enumerate(columns)
    }


def typed_value(df: DataFrame, col: Column) -> Column:
    """One struct type for values of any type, which orders as the value itself does."""
    kind = df.select(col.alias("v")).schema["v"].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType))
    real = isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType))
    return F.when(
        col.isNotNull(),
        F.struct(
            (col if whole else F.lit(None)).cast("long").alias("i"),
            (col if real else F.lit(None)).cast("double").alias("d"),
            (F.lit(None) if whole or real else col).cast("string").alias("s"),
        ),
    )


def value_text(value: str = "value") -> Column:
    col = F.col(value)
    return F.coalesce(col["s"], col["i"].cast("string"), col["d"].cast("string"))


def histogram(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(feature, value, n) for all columns together, missing values left out.

    One scan and one shuffle of counts already combined per task, whatever the number of columns; a value
    that fills a third of the table is one small row per task.
    """
    pairs = F.array(
        *[F.struct(F.lit(name).alias("feature"), typed_value(df, col).alias("value")) for name, col in columns.items()]
    )
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.feature", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(hist: DataFrame) -> DataFrame:
    """(feature, value, n, distinct, chars): the commonest value, the smallest one on ties; how many distinct
    values there are, and how many characters they take together."""
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value"))).alias("best")
    return (
        hist.groupBy("feature")
        .agg(best, F.count(F.lit(1)).alias("distinct"), F.sum(F.length(value_text())).alias("chars"))
        .select("feature", F.col("best.value").alias("value"), (-F.col("best.m")).alias("n"), "distinct", "chars")
    )


def exact_medians(df: DataFrame, columns: Mapping[str, Column], known: Mapping[str, Moments]) -> dict[str, float]:
    """The exact median (the mean of the two middle values) of each DOUBLE column, at any size.

    Columns with few distinct values use the built-in percentile. For the others a sketch gives a narrow
    bracket around the middle ranks; rows below it are counted and the sketch repeats inside it until the
    bracket's values fit a buffer. Each round is one pass for all open columns and shuffles only sketches.
    """
    out: dict[str, float] = {}
    open_: dict[str, tuple[float, float]] = {}
    easy = {c: col for c, col in columns.items() if known[c].distinct <= EXACT_BUFFER_VALUES}
    if easy:
        row = df.agg(*[F.percentile(col, F.lit(0.5)).alias(f"m{i}") for i, col in enumerate(easy.values())]).first()
        out.update(zip(easy, row, strict=True))
    for c in columns:
        if c not in easy:
            open_[c] = (known[c].low, known[c].high)
    below = dict.fromkeys(open_, 0)
    inside = {c: known[c].count for c in open_}
    while open_:
        open_, below, inside = _narrow(df, columns, known, open_, below, inside)
        done = [c for c in open_ if open_[c][0] == open_[c][1] or inside[c][1] <= EXACT_BUFFER_VALUES]
        out.update(_read_medians(df, {c: columns[c] for c in done}, known, open_, below))
        for c in done:
            del open_[c]
        below = {c: below[c] for c in open_}
        inside = {c: inside[c][0] for c in open_}
    return out


def _middle_ranks(m: Moments) -> tuple[int, int]:
    return (m.count - 1) // 2, m.count // 2


def _narrow(df, columns, known, brackets, below, inside):
    """A tighter bracket per column that provably still holds the middle ranks."""
    aggs = []
    for i, (c, (low, high)) in enumerate(brackets.items()):
        first, last = _middle_ranks(known[c])
        at = [(first - below[c]) / inside[c] - 0.002, (last - below[c] + 1) / inside[c] + 0.002]
        within = F.when(columns[c].between(low, high), columns[c])
        aggs.append(F.approx_percentile(within, [min(max(a, 0.0), 1.0) for a in at], 10_000).alias(f"b{i}"))
    guess = df.agg(*aggs).first()
    counts = []
    for i, c in enumerate(brackets):
        low, high = guess[i]
        within = columns[c].between(low, high)
        counts += [
            F.count_if(columns[c] < low).alias(f"u{i}"),
            F.count_if(within).alias(f"w{i}"),
            F.approx_count_distinct(F.when(within, columns[c])).alias(f"d{i}"),
        ]
    got = df.agg(*counts).first()
    new_brackets, new_below, new_inside = {}, {}, {}
    for i, (c, old) in enumerate(brackets.items()):
        first, last = _middle_ranks(known[c])
        holds = got[f"u{i}"] <= first and last < got[f"u{i}"] + got[f"w{i}"]
        if holds and (tuple(guess[i]) != tuple(old) or old[0] == old[1]):
            new_brackets[c], new_below[c] = tuple(guess[i]), got[f"u{i}"]
            new_inside[c] = (got[f"w{i}"], got[f"d{i}"])
        else:
            new_brackets[c], new_below[c], new_inside[c] = _halve(df, columns[c], known[c], old)
    return new_brackets, new_below, new_inside


def _halve(df, col, m, bracket):
    """Fallback when a sketch missed or stood still: cut the value range at its middle."""
    low, high = bracket
    first, last = _middle_ranks(m)
    cut = low + (high - low) / 2
    row = df.agg(
        F.count_if(col <= cut).alias("upto"),
        F.max(F.when(col <= cut, col)).alias("left_end"),
        F.min(F.when(col > cut, col)).alias("right_start"),
    ).first()
    if last < row.upto:
        parts = (low, row.left_end)
    elif first >= row.upto:
        parts = (row.right_start, high)
    else:
        parts = (row.left_end, row.right_start)
    within = col.between(*parts)
    got = df.agg(
        F.count_if(col < parts[0]).alias("u"),
        F.count_if(within).alias("w"),
        F.approx_count_distinct(F.when(within, col)).alias("d"),
    ).first()
    return parts, got.u, (got.w, got.d)


def _read_medians(df, columns, known, brackets, below) -> dict[str, float]:
    """The middle values inside brackets that hold few distinct values, by running counts."""
    if not columns:
        return {}
    hist = histogram(df, {c: F.when(col.between(*brackets[c]), col) for c, col in columns.items()})
    upto = F.sum("n").over(Window.partitionBy("feature").orderBy("value"))
    first = F.create_map(*[F.lit(x) for c in columns for x in (c, _middle_ranks(known[c])[0] - below[c])])[F.col("feature")]
    last = F.create_map(*[F.lit(x) for c in columns for x in (c, _middle_ranks(known[c])[1] - below[c])])[F.col("feature")]
    running = hist.withColumn("upto", upto).withColumn("first", first).withColumn("last", last)
    holds = [(F.col("upto") > F.col(r)) & (F.col("upto") - F.col("n") <= F.col(r)) for r in ("first", "last")]
    got = running.groupBy("feature").agg(*[F.max(F.when(h, F.col("value.d"))).alias(r) for h, r in zip(holds, ("a", "b"), strict=True)])
    return {r.feature: (r.a + r.b) / 2 for r in got.collect()}


def distinct_up_to(df: DataFrame, column: Column, k: int) -> int:
    """The number of distinct values of a column other than null, or k + 1 if there are more than k. A task keeps k + 1 values at
    most and shuffles no others."""
    one = df.select(column.alias("v")).where("v IS NOT NULL")
    kind = one.schema["v"].dataType

    def few(batches):
        held: dict = {}
        nan = float("nan")  # one object, so that it is one key
        for b in batches:
            for v in b.column(0).unique().to_pylist() if len(held) <= k else ():
                held.setdefault(v if v == v else nan, None)
                if len(held) > k:
                    break
        yield pa.RecordBatch.from_arrays([pa.array(list(held), to_arrow_type(kind))], ["v"])

    return one.mapInArrow(few, one.schema).distinct().limit(k + 1).count()
