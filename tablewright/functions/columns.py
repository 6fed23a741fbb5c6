"""Column expressions shared by the operators. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Boolean spellings, and the extra ones of the lenient mode (compared in lower case).
TRUE_WORDS, FALSE_WORDS = ("True", "1"), ("False", "0")
LENIENT_TRUE, LENIENT_FALSE = ("true", "1", "t", "yes", "y"), ("false", "0", "f", "no", "n")

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


#: Dates as text that are not ISO, tried in this order; the month comes first where numbers leave it open.
TIME_FORMATS = ("M/d/yyyy", "M/d/yyyy H:m:s", "M/d/yyyy H:m", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyy/M/d", "yyyy/M/d H:m:s", "yyyyMMdd")


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def ref(name: str) -> Column:
    """A column by its exact name, even if it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, (*_WHOLE, *_REAL, T.DecimalType))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned to NULL, so that NULL is the only missing value."""
    col = ref(name)
    return F.when(~F.isnan(col), col) if isinstance(dtype(df, name), _REAL) else col


def as_number(df: DataFrame, name: str) -> Column:
    """DOUBLE, or NULL where the value is missing or does not read as a number."""
    col, kind = present(df, name), dtype(df, name)
    if isinstance(kind, T.StringType):
        return F.when(col.rlike(NUMBER_PATTERN), F.trim(col).try_cast("double"))
    return col.cast("double") if is_numeric(kind) or isinstance(kind, T.BooleanType) else F.lit(None).cast("double")


def as_time(df: DataFrame, name: str) -> Column:
    """TIMESTAMP, or NULL. Whole numbers count nanoseconds since 1970."""
    col, kind = present(df, name), dtype(df, name)
    if isinstance(kind, _TIMES):
        return col.cast("timestamp")
    if isinstance(kind, _WHOLE):
        return F.timestamp_micros(F.floor(col.cast("long") / 1000))
    if not isinstance(kind, T.StringType):
        return F.lit(None).cast("timestamp")
    return F.coalesce(F.try_to_timestamp(col), *[F.try_to_timestamp(F.trim(col), F.lit(f)) for f in TIME_FORMATS])


def as_flag(df: DataFrame, name: str, lenient: bool = False) -> Column:
    """1 / 0, or NULL where the value is missing or not one of the accepted spellings."""
    col, kind = present(df, name), dtype(df, name)
    if isinstance(kind, T.BooleanType):
        return col.cast("int")
    if is_numeric(kind):
        return F.when(col == 1, 1).when(col == 0, 0)
    text, true, false = (F.lower(F.trim(col)), LENIENT_TRUE, LENIENT_FALSE) if lenient else (col, TRUE_WORDS, FALSE_WORDS)
    return F.when(text.isin(*true), 1).when(text.isin(*false), 0)


def as_category(df: DataFrame, name: str) -> Column:
    """The value in the type that decides its order: BIGINT, DOUBLE or STRING."""
    col, kind = present(df, name), dtype(df, name)
    if isinstance(kind, _WHOLE):
        return col.cast("long")
    return col.cast("double") if is_numeric(kind) else col.cast("string")


def category_text(df: DataFrame, name: str) -> Column:
    return as_category(df, name).cast("string")


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores, in any script."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def key_text(df: DataFrame, key: str | Sequence[str] | None) -> Column:
    """What identifies a row: one column, several, or (without a key) a 64-bit digest of the whole row. Rows that
    share an identity are told apart by the operators that must, so a digest need not be unique."""
    if isinstance(key, str):
        return F.coalesce(ref(key).cast("string"), F.lit("\u0000"))
    if key:
        return F.concat_ws("|", *[F.coalesce(ref(c).cast("string"), F.lit("\u0000")) for c in key])
    return F.xxhash64(*[hashable(df, c) for c in df.columns]).cast("string")


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return kind.typeName() in ("map", "variant")


def hashable(df: DataFrame, name: str) -> Column:
    """The column, or its text if a map in it, at any depth, cannot be hashed."""
    return ref(name).cast("string") if _holds_map(dtype(df, name)) else ref(name)


def portable_hash(key: Column, seed: int) -> Column:
    """32 evenly spread bits of a row key, the same in every engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
