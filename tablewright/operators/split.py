"""Exact, reproducible splits by the hash of a row key.

Rows are ordered by (hash, key). A split is a cut in that order, so all that must be found is the row at
each cut: two grouped counts over hash bits (the second only of rows near a cut) and one look at the few
rows that share a cut's hash. The table itself is never sorted or shuffled; applying a split is a filter-like
expression over constants. The result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.columns import hashable, key_text, portable_hash, ref
from tablewright.functions.storage import cut_lineage

COARSE_SHIFT = 20  # the first count looks at the top 12 of 32 hash bits
LOCAL_ROWS = 1_000_000  # up to here one task may number a group of equal keys
LITERAL_CUTS = 200  # up to here cuts are constants of one expression, beyond it a joined table
BROADCAST_CUTS = 100_000
SALTS = 64

_S, _H, _K = "__stratum", "__hash", "__key"


@dataclass(frozen=True)
class Cut:
    """The first ``rank`` rows of a stratum end inside the rows whose (hash, key) is this one: ``take`` of
    those ``ties`` rows come before the cut."""

    stratum: str
    rank: int
    hash: int
    key: str
    take: int
    ties: int


def _keyed(df: DataFrame, key, seed: int, stratum: str | None) -> DataFrame:
    text = key_text(df, key)
    s = F.coalesce(ref(stratum).cast("string"), F.lit("\u0000")) if stratum else F.lit("")
    return df.withColumns({_S: s, _H: portable_hash(text, seed), _K: text})


def _find(counts: DataFrame, by: list[str], wanted: DataFrame) -> DataFrame:
    """For each wanted (stratum, rank, before): the group in which that many rows are reached, and how many
    rows precede it. ``counts`` holds few rows per partition of the window by construction."""
    order = [c for c in counts.columns if c not in (*by, "n")]
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(*order))
    running = counts.withColumn("upto", upto)
    inside = (F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left"))
    found = running.join(wanted, by).where(inside)
    return found.withColumn("left", F.col("left") - (F.col("upto") - F.col("n"))).drop("upto")


def _hint(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_CUTS else df


def _settle(df: DataFrame, rows: int) -> DataFrame:
    """Compute a table of at most ``rows`` rows once, so the next step does not repeat the scan behind it."""
    if rows <= BROADCAST_CUTS:
        return df.sparkSession.createDataFrame(df.collect(), df.schema)
    return cut_lineage(df)


def find_cuts(keyed: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """``wanted`` (stratum, rank) -> (stratum, rank, hash, key, take, ties); ranks are at least 1."""
    coarse = F.shiftright(F.col(_H), COARSE_SHIFT).alias("__coarse")
    first = keyed.groupBy(_S, coarse).agg(F.count(F.lit(1)).alias("n"))
    near = _settle(_find(first, [_S], _hint(wanted.withColumn("left", F.col("rank")), n_wanted)).drop("n"), n_wanted)
    fine = (
        keyed.select(_S, _H, _K, coarse)
        .join(_hint(near.select(_S, "__coarse"), n_wanted), [_S, "__coarse"], "left_semi")
        .groupBy(_S, "__coarse", _H)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at_hash = _settle(_find(fine, [_S, "__coarse"], _hint(near, n_wanted)).drop("n"), n_wanted)
    keys = (
        keyed.select(_S, _H, _K)
        .join(_hint(at_hash.select(_S, _H), n_wanted), [_S, _H], "left_semi")
        .groupBy(_S, _H, _K)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at_key = _find(keys, [_S, _H], _hint(at_hash, n_wanted))
    found = at_key.select(
        F.col(_S).alias("stratum"),
        "rank",
        F.col(_H).alias("hash"),
        F.col(_K).alias("key"),
        F.col("left").alias("take"),
        F.col("n").alias("ties"),
    )
    return _settle(found, n_wanted)


def _before(hash_: Column, key: Column) -> Column:
    """Whether a row lies wholly before a cut's row in (hash, key) order."""
    return (F.col(_H) < hash_) | ((F.col(_H) == hash_) & (F.col(_K) < key))


def _parts(keyed: DataFrame, cuts: list[Cut]) -> Column:
    """How many cuts a row lies behind, within its stratum."""
    by_stratum: dict[str, list[Cut]] = {}
    for c in cuts:
        by_stratum.setdefault(c.stratum, []).append(c)
    out = F.lit(0)
    for stratum, mine in by_stratum.items():
        passed = F.lit(0)
        for c in mine:
            tied = (F.col(_H) == c.hash) & (F.col(_K) == c.key)
            before = _before(F.lit(c.hash), F.lit(c.key)) | (tied & F.lit(c.take == c.ties))
            if c.take < c.ties:
                before = before | (tied & (F.coalesce(F.col("__tie"), F.lit(0)) >= 1) & (F.col("__tie") <= c.take))
            passed = passed + F.when(before, 0).otherwise(1)
        out = F.when(F.col(_S) == stratum, passed).otherwise(out)
    return out


def _number_ties(rows: DataFrame, size: int) -> DataFrame:
    """1..size for rows that share stratum, hash and key. Big groups are spread over salts first, whose
    counts then give each salt its offset; the checkpoint fixes which row has which salt."""
    data = [c for c in rows.columns if c not in (_S, _H, _K)]
    order = F.xxhash64(*[hashable(rows, c) for c in data]) if data else F.lit(0)
    if size <= LOCAL_ROWS:
        return rows.withColumn("__tie", F.row_number().over(Window.partitionBy(_S, _H, _K).orderBy(order)).cast("long"))
    salts = ceil(size / LOCAL_ROWS) * 4
    salted = cut_lineage(rows.withColumn("__salt", F.floor(F.rand(7) * salts).cast("int")))
    counts = salted.groupBy(_S, _H, _K, "__salt").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.sum("n").over(Window.partitionBy(_S, _H, _K).orderBy("__salt")) - F.col("n")
    offsets = counts.withColumn("ahead", ahead).drop("n")
    inner = F.row_number().over(Window.partitionBy(_S, _H, _K, "__salt").orderBy(order))
    return (
        salted.withColumn("inner", inner)
        .join(_hint(offsets, salts), [_S, _H, _K, "__salt"])
        .withColumn("__tie", F.col("ahead") + F.col("inner"))
        .drop("inner", "ahead", "__salt")
    )


def _apply(keyed: DataFrame, cuts: list[Cut], out: str) -> DataFrame:
    """Constant cuts. Only rows of a key that a cut splits (repeated keys) are numbered."""
    split_keys = [c for c in cuts if c.take < c.ties]
    helper = [_S, _H, _K]
    if not split_keys:
        return keyed.withColumn(out, _parts(keyed, cuts)).drop(*helper)
    tied = F.lit(False)
    for c in split_keys:
        tied = tied | ((F.col(_S) == c.stratum) & (F.col(_H) == c.hash) & (F.col(_K) == c.key))
    rest = keyed.where(~tied).withColumn("__tie", F.lit(None).cast("long"))
    numbered = _number_ties(keyed.where(tied), max(c.ties for c in split_keys))
    whole = rest.unionByName(numbered)
    return whole.withColumn(out, _parts(whole, cuts)).drop(*helper, "__tie")


def _apply_joined(keyed: DataFrame, cuts: DataFrame, n_cuts: int, out: str) -> DataFrame:
    """One cut per stratum, too many strata for constants: join the cuts by stratum. A stratum without a cut
    lies wholly behind it. Beyond broadcast size each cut is repeated per salt, and rows take theirs from their
    hash, so a stratum of a third of the rows is still many small groups."""
    c = cuts.select(F.col("stratum").alias(_S), F.col("hash").alias("__ch"), F.col("key").alias("__ck"), "take", "ties")
    if n_cuts <= BROADCAST_CUTS:
        joined = keyed.join(F.broadcast(c), _S, "left")
    else:
        salted = c.withColumn("__z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = keyed.withColumn("__z", F.col(_H) % SALTS).join(salted, [_S, "__z"], "left").drop("__z")
    at_cut = F.coalesce((F.col(_H) == F.col("__ch")) & (F.col(_K) == F.col("__ck")), F.lit(False))
    tied = at_cut & (F.col("take") < F.col("ties"))
    rest = joined.where(~tied).withColumn("__tie", F.lit(None).cast("long"))
    largest = cuts.agg(F.max(F.when(F.col("take") < F.col("ties"), F.col("ties")))).first()[0]
    whole = rest.unionByName(_number_ties(joined.where(tied), largest)) if largest else rest
    before = _before(F.col("__ch"), F.col("__ck")) | (at_cut & (F.coalesce(F.col("__tie"), F.col("ties")) <= F.col("take")))
    passed = F.when(F.col("__ch").isNull(), 1).when(before, 0).otherwise(1)
    return whole.withColumn(out, passed).drop(_S, _H, _K, "__ch", "__ck", "take", "ties", "__tie")


def _collect_cuts(cuts: DataFrame) -> list[Cut]:
    return [Cut(r.stratum, r.rank, r.hash, r.key, r.take, r.ties) for r in cuts.collect()]


def _label_sides(df: DataFrame, part: str, name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(part) == 0, "test").otherwise("train")).drop(part)


def random_split(
    df: DataFrame, test_size: float = 0.2, key: str | Sequence[str] | None = None, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Adds ``split``: exactly ceil(test_size * n) rows 'test', the others 'train'."""
    keyed = _keyed(df, key, seed, None)
    n_test = _n_test(df.count(), test_size)
    return _label_sides(_cut_ranks(keyed, [n_test], "__part"), "__part", name)


def _n_test(n: int, test_size: float) -> int:
    return min(n, ceil(round(test_size * n, 9)))


def _cut_ranks(keyed: DataFrame, ranks: list[int], out: str) -> DataFrame:
    """Number of ranks a row lies behind, in one stratum; rank 0 lies before every row."""
    positive = [r for r in ranks if r > 0]
    base = len(ranks) - len(positive)
    if not positive:
        return keyed.withColumn(out, F.lit(base)).drop(_S, _H, _K)
    wanted = keyed.sparkSession.createDataFrame([("", r) for r in sorted(set(positive))], f"{_S} string, rank long")
    cuts = _collect_cuts(find_cuts(keyed, wanted, len(positive)))
    by_rank = {c.rank: c for c in cuts}
    found = [by_rank[r] for r in positive]
    parted = _apply(keyed, found, out)
    return parted.withColumn(out, F.col(out) + base) if base else parted


def class_shares(classes: DataFrame, n: int, n_test: int) -> DataFrame:
    """``classes`` (label, n) with ``base``, the whole test rows of each class, and ``rest``, what its share has beyond them (times
    ``n``). Whole numbers decide remainders; 38 digits hold the product of any two row counts."""
    wide = "decimal(19,0)"
    shared = classes.withColumn("share", F.col("n").cast(wide) * F.lit(n_test).cast(wide))
    base = shared.withColumn("base", F.expr(f"share div CAST({n} AS {wide})").cast("long"))
    return base.withColumn("rest", F.col("share") - F.col("base").cast(wide) * F.lit(n).cast(wide)).drop("share")


def stratified_split(
    df: DataFrame,
    label: str,
    test_size: float = 0.2,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Each class gives its share of the ceil(test_size * n) test rows, by largest remainder (ties to the smaller
    label). Falls back to a random split where a class has one row or a side has fewer rows than classes."""
    classes = df.groupBy(ref(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    facts = classes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).first()
    n = facts["rows"] or 0
    n_test = _n_test(n, test_size)
    enough = n > 0 and facts.least >= 2 and 2 * facts.classes <= n and facts.classes <= min(n_test, n - n_test)
    if not enough:
        return random_split(df, test_size, key, seed, name)
    base = class_shares(classes, n, n_test)
    extra = n_test - base.agg(F.sum("base")).first()[0]
    more = base.orderBy(F.desc("rest"), "label").limit(extra).select(F.col("label").alias("lucky"))
    alloc = base.join(more, F.col("label").eqNullSafe(F.col("lucky")), "left")
    quota = (F.col("base") + F.when(F.col("lucky").isNotNull(), 1).otherwise(0)).alias("rank")
    wanted = alloc.select(F.coalesce(F.col("label").cast("string"), F.lit("\u0000")).alias(_S), quota)
    keyed = _keyed(df, key, seed, label)
    cuts = find_cuts(keyed, wanted.where("rank > 0"), facts.classes)
    if facts.classes <= LITERAL_CUTS:
        found = _collect_cuts(cuts)
        served = [c.stratum for c in found]
        parted = _apply(keyed, found, "__part")
        if len(served) < facts.classes:  # a class whose share is no row is all training data
            unserved = ~F.coalesce(ref(label).cast("string"), F.lit("\u0000")).isin(served)
            parted = parted.withColumn("__part", F.when(unserved, 1).otherwise(F.col("__part")))
    else:
        parted = _apply_joined(keyed, cuts, facts.classes, "__part")
    return _label_sides(parted, "__part", name)


def assign_folds(
    df: DataFrame, k: int = 5, key: str | Sequence[str] | None = None, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Adds ``fold`` 0..k-1: consecutive stretches of the hash order, whose sizes differ by at most one."""
    if k < 2:
        raise ValueError("k must be at least 2")
    n = df.count()
    if n < k:
        raise ValueError(f"cannot make {k} folds of {n} rows")
    ends = [(j + 1) * (n // k) + min(j + 1, n % k) for j in range(k - 1)]
    return _cut_ranks(_keyed(df, key, seed, None), ends, name)


def split(
    df: DataFrame, target: str, target_type: str, test_size: float, stratify: bool, key=None, seed: int = 42
) -> DataFrame:
    if stratify and target_type in ("binary", "multiclass"):
        return stratified_split(df, target, test_size, key, seed)
    return random_split(df, test_size, key, seed)
