"""Shapley values of any model from its scores, by weighted least squares over coalitions (Lundberg and Lee, 2017).

A coalition keeps a row's values for its features and takes the others from the background. Tasks make the coalitions from a seed, so
none are shipped: all of them where they are few enough, else pairs of a drawn coalition and its opposite. All mixtures go through one
prediction pass in the order they are made; each task sums, for a row and a block of coalitions, what the least squares need, and
one small shuffle brings a row's blocks together. The blocks left out in turn (jackknife) give standard errors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 64  # coalitions
FOLDS = 16  # of blocks, for the standard errors


def default_coalitions(width: int) -> int:
    return 2 * width + 2048  # fixed value


def is_exact(width: int, coalitions: int) -> bool:
    """Whether all coalitions but the empty and the full one are that few."""
    return width < 60 and 2**width - 2 <= coalitions


def blocks(width: int, coalitions: int, exact: bool) -> int:
    n = 2**width - 2 if exact else 2 * ((coalitions + 1) // 2)
    return -(-n // BLOCK)


def block_of(number: int, width: int, coalitions: int, exact: bool, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(masks, weights) of one block of coalitions."""
    if exact:
        codes = np.arange(1 + number * BLOCK, min(1 + (number + 1) * BLOCK, 2**width - 1))
        masks = (codes[:, None] >> np.arange(width)) & 1 == 1
        size = masks.sum(axis=1)
        return masks, np.array([(width - 1) / (comb(width, s) * s * (width - s)) for s in size.tolist()])
    rng = np.random.default_rng([seed, number])
    sizes = np.arange(1, width)
    chance = 1 / (sizes * (width - sizes))
    pairs = min(BLOCK // 2, (coalitions + 1) // 2 - number * BLOCK // 2)
    masks = np.zeros((pairs, width), bool)
    for m, s in zip(masks, rng.choice(sizes, pairs, p=chance / chance.sum())):
        m[rng.choice(width, s, replace=False)] = True
    return np.concatenate([masks, ~masks]), np.ones(2 * pairs)


def _solved(a: np.ndarray, b: np.ndarray, gain: float) -> np.ndarray:
    """The least squares solution whose entries add up to ``gain``."""
    inverse = np.linalg.pinv(a, hermitian=True)
    raw, ones = inverse @ b, inverse.sum(axis=1)
    return raw - ones * ((raw.sum() - gain) / ones.sum())


def _normal(width: int, coalitions: int, exact: bool, seed: int) -> np.ndarray:
    """Sums of weight * mask * mask' of the blocks of each fold."""
    out = np.zeros((FOLDS, width, width))
    for k in range(blocks(width, coalitions, exact)):
        masks, w = block_of(k, width, coalitions, exact, seed)
        z = masks.astype(float)
        out[k % FOLDS] += (z * w[:, None]).T @ z
    return out


def kernel_contributions(trained, df: DataFrame, picked: np.ndarray, keep: Sequence[str], coalitions: int, exact: bool, seed: int, output: str) -> tuple[DataFrame, float]:
    """(keep..., class, phi[], error[]) and the base value. ``keep`` identifies a row; ``picked`` are the background rows."""
    spark, width = df.sparkSession, picked.shape[1]
    behind = spark.createDataFrame([(r.tolist(),) for r in picked], "x array<double>").select(array_to_vector("x").alias("features"))
    base = float(trained.predict(behind).agg(F.avg(output)).first()[0])
    names = [f"__k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keep, names, strict=True)], "features")
    whole = trained.predict(rows).select(*names, F.col(output).cast("double").alias("__full"), vector_to_array("features").alias("__x"))
    n_blocks = max(1, blocks(width, coalitions, exact))
    dealt = whole.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).repartition(spark.sparkContext.defaultParallelism, *names, "__block")
    mixed_schema = T.StructType([*[dealt.schema[n] for n in names], T.StructField("__block", T.IntegerType()), T.StructField("__at", T.IntegerType()), dealt.schema["__full"], T.StructField("__m", T.ArrayType(T.DoubleType()))])
    behind_each = len(picked)

    def mixtures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x, k = b.column("__x")[i].values.to_numpy(zero_copy_only=False), b.column("__block")[i].as_py()
                masks = block_of(k, width, coalitions, exact, seed)[0] if width > 1 else np.zeros((0, width), bool)
                mixed = np.where(masks[:, None, :], x, picked[None]).reshape(-1, width)
                n = len(mixed)
                if n:
                    same = [b.column(c).take(pa.array(np.full(n, i))) for c in (*names, "__block")]
                    lists = pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), mixed.ravel())
                    yield pa.RecordBatch.from_arrays([*same, pa.array(np.repeat(np.arange(len(masks), dtype=np.int32), behind_each)), b.column("__full").take(pa.array(np.full(n, i))), lists], mixed_schema.fieldNames())
                else:  # one feature: nothing lies between the empty and the full coalition
                    one = b.slice(i, 1)
                    yield pa.RecordBatch.from_arrays([*[one.column(c) for c in (*names, "__block")], pa.array([-1], pa.int32()), one.column("__full"), pa.array([x.tolist()], pa.list_(pa.float64()))], mixed_schema.fieldNames())

    mixed = dealt.mapInArrow(mixtures, mixed_schema).withColumn("features", array_to_vector("__m"))
    scored = trained.predict(mixed).select(*names, "__block", "__at", "__full", F.col(output).cast("double").alias("__v"))
    sums_schema = T.StructType([*[scored.schema[n] for n in names], T.StructField("__block", T.IntegerType()), scored.schema["__full"], T.StructField("__b", T.ArrayType(T.DoubleType()))])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of weight * mask * (mean score - base) of stretches of rows of one block; a stretch is a row's, or a part of it."""
        for b in batches:
            at, block, v = (b.column(c).to_numpy(zero_copy_only=False) for c in ("__at", "__block", "__v"))
            new = np.concatenate([[True], (block[1:] != block[:-1]) | (at[1:] < at[:-1]) | (at[1:] < 0)]) if len(at) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            out = np.zeros((len(starts), width))
            for s, (a, e) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(at)])):
                if at[a] >= 0:
                    masks, w = block_of(int(block[a]), width, coalitions, exact, seed)
                    out[s] = ((v[a:e] - base) * w[at[a:e]] / behind_each) @ masks[at[a:e]]
            some = b.take(pa.array(starts))
            lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, width, dtype=np.int32), out.ravel())
            yield pa.RecordBatch.from_arrays([*[some.column(n) for n in names], some.column("__block"), some.column("__full"), lists], sums_schema.fieldNames())

    sums = scored.mapInArrow(summed, sums_schema)
    per_row = sums.groupBy(*names).agg(F.first("__full").alias("full"), F.collect_list(F.struct("__block", "__b")).alias("sums"))

    def solve(full: pa.Array, parts: pa.Array) -> pa.Array:
        folds = _normal(width, coalitions, exact, seed)
        phi, error = [], []
        for f, p in zip(full.to_pylist(), parts.to_pylist(), strict=True):
            b = np.zeros((FOLDS, width))
            for s in p:
                b[s["__block"] % FOLDS] += s["__b"]
            gain = f - base
            best = _solved(folds.sum(axis=0), b.sum(axis=0), gain) if width > 1 else np.array([gain])
            phi.append(best.tolist())
            used = [k for k in range(FOLDS) if folds[k].any()]
            if exact or len(used) < 2:
                error.append([0.0 if exact or width == 1 else None] * width)
            else:
                left = np.stack([_solved(folds.sum(axis=0) - folds[k], b.sum(axis=0) - b[k], gain) for k in used])
                n = len(used)
                error.append(np.sqrt((n - 1) / n * ((left - left.mean(axis=0)) ** 2).sum(axis=0)).tolist())
        kind = pa.list_(pa.float64())
        return pa.StructArray.from_arrays([pa.array(phi, kind), pa.array(error, kind)], ["phi", "error"])

    solved = F.arrow_udf(solve, "struct<phi array<double>, error array<double>>")
    out = per_row.withColumn("s", solved("full", "sums"))
    return out.select(*[F.col(n).alias(o) for n, o in zip(names, keep, strict=True)], F.lit(0).alias("class"), "s.phi", "s.error"), base
