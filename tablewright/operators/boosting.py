"""Second-order gradient boosting of histogram trees (Chen and Guestrin, 2016), grown level by level on Spark.

Feature values become bin numbers once. A level of all trees of a round is one pass: every task adds gradients and Hessians of its
rows to a histogram for each (tree, node, feature), one shuffle brings the histograms of a node and feature together, and the task that
sums them finds the best cut. Only the best cut of each node and task reaches the driver. The trees of a round, one for each class,
grow side by side, so classes cost no passes. Margins are not written after every round but made again from the last few
trees, and stored every STORED rounds, so no lineage grows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.storage import new_path
from tablewright.functions.vectors import entries, matrix, width

# Defaults of the parameters users may leave out.
DEFAULTS = {
    "n_estimators": 100, "learning_rate": 0.3, "max_depth": 6, "reg_lambda": 1.0, "reg_alpha": 0.0, "gamma": 0.0,
    "min_child_weight": 1.0, "subsample": 1.0, "colsample_bytree": 1.0, "max_bins": 256, "base_score": None,
}
PATIENCE = 10  # rounds without a better loss before an early stop
STORED = 8  # rounds between two tables of margins
POINTS = 1024  # of a task's summary of a feature; a feature with fewer distinct values is summed up exactly
LEAST_GAIN = 1e-6
MOST_SUMS = 1 << 22  # nodes times bins that a task holds sums of
_MILD = 1e-16  # least Hessian of a row


@dataclass
class Tree:
    """Nodes as arrays; the root is node 0. A node without a feature (-1) is a leaf. Rows with x <= cut go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for name, empty in (("feature", -1), ("bin", -1), ("cut", 0.0), ("left", -1), ("right", -1), ("value", 0.0), ("cover", 0.0), ("gain", 0.0)):
            getattr(self, name).append(empty)
        return len(self.feature) - 1

    def nodes_of(self, x: np.ndarray, by: str, column: np.ndarray | None = None) -> np.ndarray:
        """The node each row ends in. ``by`` is cut (x holds values) or bin; ``column`` maps features to columns of x."""
        feature, limit, left, right = (np.asarray(getattr(self, k)) for k in ("feature", by, "left", "right"))
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            f = feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            if not len(rows):
                return at
            node = at[rows]
            goes_left = x[rows, f if column is None else column[f]] <= limit[node]
            at[rows] = np.where(goes_left, left[node], right[node])

    def leaf_values(self, x: np.ndarray, by: str, column: np.ndarray | None = None) -> np.ndarray:
        return np.asarray(self.value)[self.nodes_of(x, by, column)]


def gradients(task: str, classes: int, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by every margin, rows by trees."""
    if task == "regression":
        return margin - y[:, None], np.ones_like(margin)
    if classes <= 2:
        p = 1 / (1 + np.exp(-margin))
        return p - y[:, None], np.maximum(p * (1 - p), _MILD)
    p = softmax(margin)
    return p - (y[:, None] == np.arange(classes)), np.maximum(2 * p * (1 - p), _MILD)


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def losses(task: str, classes: int, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared error, or the negative log likelihood, of each row."""
    if task == "regression":
        return (margin[:, 0] - y) ** 2
    if classes <= 2:
        return np.logaddexp(0, np.where(y > 0, -1, 1) * margin[:, 0])
    top = margin.max(axis=1)
    return top + np.log(np.exp(margin - top[:, None]).sum(axis=1)) - margin[np.arange(len(y)), y.astype(np.int64)]


@dataclass
class Penalties:
    reg_lambda: float
    reg_alpha: float
    gamma: float
    min_child_weight: float

    def weight(self, g, h):
        """The best value of a node."""
        shrunk = np.sign(g) * np.maximum(np.abs(g) - self.reg_alpha, 0)
        return -shrunk / (h + self.reg_lambda + _MILD)

    def score(self, g, h):
        shrunk = np.maximum(np.abs(g) - self.reg_alpha, 0)
        return shrunk * shrunk / (h + self.reg_lambda + _MILD)

    def best_cut(self, g: np.ndarray, h: np.ndarray) -> tuple[float, int, float, float] | None:
        """(gain, last bin of the left side, its gradients, its Hessians) of one node and feature; the first of equal cuts."""
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        total_g, total_h = g.sum(), h.sum()
        gr, hr = total_g - gl, total_h - hl
        ok = (hl >= max(self.min_child_weight, _MILD)) & (hr >= max(self.min_child_weight, _MILD))
        if not ok.any():
            return None
        gain = np.where(ok, self.score(gl, hl) + self.score(gr, hr) - self.score(total_g, total_h), -np.inf)
        b = int(np.argmax(gain))
        return (float(gain[b]), b, float(gl[b]), float(hl[b])) if gain[b] > LEAST_GAIN else None


# ------------------------------------------------------------------------------------------------ bins


def _summary(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with weights; beyond ``points`` of them, values at equal shares of the weight."""
    order = np.argsort(values, kind="stable")
    v, w = values[order], weights[order]
    heads = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
    v, w = v[heads], np.add.reduceat(w, heads) if len(v) else w
    if len(v) <= points:
        return v, w
    upto = np.cumsum(w)
    at = np.unique(np.searchsorted(upto, upto[-1] * (np.arange(1, points + 1) / points) * (1 - 1e-12)))
    return v[at], np.diff(np.concatenate([[0], upto[at]]))


def _cuts_of(v: np.ndarray, w: np.ndarray, bins: int) -> np.ndarray:
    """Upper ends of all bins but the last: between neighbouring values, at equal shares if there are too many."""
    if len(v) > bins:
        upto = np.cumsum(w)
        last = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, bins) / bins))
        last = last[last < len(v) - 1]
    else:
        last = np.arange(len(v) - 1)
    return v[last] + (v[last + 1] - v[last]) / 2


def find_cuts(df: DataFrame, bins: int, weight: str | None = None) -> list[np.ndarray]:
    """The cuts of every feature, from one pass. A row counts as many times as ``weight`` says. A task sums up a feature in POINTS weighted values at most; the summaries of one
    feature meet in one task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            if not b.num_rows:
                continue
            column, n = b.column(0), width(b.column(0))
            held = held or [(np.empty(0), np.empty(0))] * n
            each = b.column(1).to_numpy()
            for at in range(0, n, 256):
                x = matrix(column, np.arange(at, min(n, at + 256)))
                for k in range(x.shape[1]):
                    v, w = held[at + k]
                    held[at + k] = _summary(np.concatenate([v, x[:, k]]), np.concatenate([w, each]), 4 * POINTS)
        for f, (v, w) in enumerate(held):
            v, w = _summary(v, w, POINTS)
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([v.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], ["feature", "v", "w"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for f, v, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                old = held.get(f, (np.empty(0), np.empty(0)))
                held[f] = _summary(np.concatenate([old[0], np.frombuffer(v)]), np.concatenate([old[1], np.frombuffer(w)]), 16 * POINTS)
        for f, (v, w) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([_cuts_of(v, w, bins).tobytes()], pa.binary())], ["feature", "cuts"])

    rows = df.select("features", _weights(weight)).mapInArrow(sums, "feature int, v binary, w binary").repartition("feature").mapInArrow(merged, "feature int, cuts binary").collect()
    return [np.frombuffer(r.cuts) for r in sorted(rows, key=lambda r: r.feature)]


def _weights(weight: str | None):
    return (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight")


def _binned(df: DataFrame, cuts: list[np.ndarray], seed: int, held_out, weight: str | None = None) -> DataFrame:
    """(y, bins, draw, held, weight): bin numbers of all features as bytes, a number drawn for the row, whether it is held out, and how
    many times it counts."""
    kind = np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16
    features = np.arange(len(cuts))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.empty((b.num_rows, len(cuts)), kind)
            for at in range(0, len(cuts), 256):
                x = matrix(b.column(0), features[at : at + 256])
                for k in range(x.shape[1]):
                    out[:, at + k] = np.searchsorted(cuts[at + k], x[:, k], side="left")
            bins = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(1), bins, *b.columns[2:]], ["y", "bins", "draw", "held", "weight"])

    draw = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed))
    given = df.select("features", F.col("label").cast("double").alias("y"), draw.alias("draw"), (held_out if held_out is not None else F.lit(False)).alias("held"), _weights(weight))
    return given.mapInArrow(each, "y double, bins binary, draw long, held boolean, weight double")


def _bin_matrix(column: pa.Array, features: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), features)


# --------------------------------------------------------------------------------------------- growing


@dataclass
class _Round:
    """What a pass knows: rows' stored margins are those after ``since`` rounds."""

    task: str
    classes: int
    base: list[float]
    recent: list[list[Tree]]
    growing: list[Tree]
    active: list[list[int]]  # nodes of each growing tree that may be cut
    columns: np.ndarray  # features of this round
    bins: list[int]  # of every feature
    kind: Any
    penalties: Penalties
    subsample: float
    number: int
    seed: int

    def margins(self, x: np.ndarray, stored: np.ndarray) -> np.ndarray:
        out = stored.copy()
        for trees in self.recent:
            for k, t in enumerate(trees):
                out[:, k] += t.leaf_values(x, "bin")
        return out


def _chosen(draw: np.ndarray, share: float, number: int, seed: int) -> np.ndarray:
    """Rows of this round's sample."""
    if share >= 1:
        return np.ones(len(draw), bool)
    x = draw.view(np.uint64) + np.uint64((number * 0x9E3779B97F4A7C15 + seed) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(share, 1.0) * 2**64 - 1)


_HIST = "tree int, node int, feature int, sums binary"
_BEST = "tree int, node int, feature int, gain double, bin int, gl double, hl double, g double, h double"


def _histograms(r: _Round):
    trees, n_features = len(r.growing), len(r.bins)
    offsets = np.concatenate([[0], np.cumsum([r.bins[f] for f in r.columns])]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = int(offsets[-1])
        sums = [np.zeros((len(nodes), 2, total)) for nodes in r.active]
        loss = np.zeros(4)  # held out: loss, rows; the others: loss, rows
        for b in batches:
            if not b.num_rows:
                continue
            y, held = b.column(0).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False)
            x = _bin_matrix(b.column(1), n_features, r.kind)
            margin = r.margins(x, b.column(5).flatten().to_numpy(zero_copy_only=False).reshape(len(y), trees))
            weight = b.column(4).to_numpy(zero_copy_only=False)
            each = losses(r.task, r.classes, margin, y) * weight
            loss += each[held].sum(), weight[held].sum(), each[~held].sum(), weight[~held].sum()
            use = ~held & _chosen(b.column(2).to_numpy(zero_copy_only=False), r.subsample, r.number, r.seed)
            x, (g, h) = x[use], (d * weight[use, None] for d in gradients(r.task, r.classes, margin[use], y[use]))
            for k, (tree, nodes) in enumerate(zip(r.growing, r.active, strict=True)):
                if not nodes:
                    continue
                slot_of = np.full(len(tree.feature), -1)
                slot_of[nodes] = np.arange(len(nodes))
                slot = slot_of[tree.nodes_of(x, "bin")]
                here = slot >= 0
                for c, f in enumerate(r.columns):
                    lo, hi = int(offsets[c]), int(offsets[c + 1])
                    at = slot[here] * (hi - lo) + x[here, f]
                    for which, values in enumerate((g[here, k], h[here, k])):
                        sums[k][:, which, lo:hi] += np.bincount(at, values, len(nodes) * (hi - lo)).reshape(len(nodes), -1)
        rows = [(k, node, int(f), np.ascontiguousarray(sums[k][s][:, offsets[c] : offsets[c + 1]]).tobytes()) for k, nodes in enumerate(r.active) for s, node in enumerate(nodes) if sums[k][s, 1].any() for c, f in enumerate(r.columns)]
        rows.append((-1, 0, -1, loss.tobytes()))
        for at in range(0, len(rows), 2000):
            columns = list(zip(*rows[at : at + 2000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["tree", "node", "feature", "sums"])

    return run


def _best_cuts(penalties: Penalties):
    """Sums the histograms of each (tree, node, feature); the best cut of each node among this task's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], np.ndarray] = {}
        for b in batches:
            for tree, node, feature, sums in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = np.frombuffer(sums)
                key = tree, node, feature
                held[key] = held[key] + s if key in held else s
        best: dict[tuple[int, int], tuple] = {}
        for (tree, node, feature), s in sorted(held.items()):
            if tree < 0:
                best[tree, node] = (tree, node, feature, 0.0, 0, *s.tolist())
                continue
            g, h = s.reshape(2, -1)
            found = penalties.best_cut(g, h) or (-1.0, -1, 0.0, 0.0)
            if (tree, node) not in best or found[0] > best[tree, node][3]:
                best[tree, node] = (tree, node, feature, *found, float(g.sum()), float(h.sum()))
        if best:
            columns = list(zip(*best.values(), strict=True))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["tree", "node", "feature", "gain", "bin", "gl", "hl", "g", "h"])

    return run


def _level(rows: DataFrame, r: _Round) -> tuple[dict[tuple[int, int], Any], np.ndarray]:
    """The best cut of every active node, and the losses before this round. Features whose histograms are too much for a task go in
    several passes."""
    nodes = max(1, sum(map(len, r.active)))
    block = (np.cumsum([r.bins[f] for f in r.columns]) * nodes) // MOST_SUMS
    best: dict[tuple[int, int], Any] = {}
    loss = np.zeros(4)
    for n, b in enumerate(np.unique(block)):
        one = replace(r, columns=r.columns[block == b])
        parts = min(len(one.columns) * nodes, rows.sparkSession.sparkContext.defaultParallelism)
        sums = rows.mapInArrow(_histograms(one), _HIST)
        for f in sums.repartition(parts, "tree", "node", "feature").mapInArrow(_best_cuts(r.penalties), _BEST).collect():
            if f.tree < 0:
                loss += (f.gl, f.hl, f.g, f.h) if not n else 0.0
            elif (old := best.get((f.tree, f.node))) is None or (-f.gain, f.feature) < (-old.gain, old.feature):
                best[f.tree, f.node] = f
    return best, loss


def _pruned(t: Tree, gamma: float) -> Tree:
    """Cuts of less gain than ``gamma`` go, from below."""
    for node in range(len(t.feature) - 1, -1, -1):
        if t.feature[node] >= 0 and t.gain[node] < gamma and t.feature[t.left[node]] < 0 and t.feature[t.right[node]] < 0:
            t.feature[node], t.left[node], t.right[node] = -1, -1, -1
    return t


def _grown(rows: DataFrame, r: _Round, depth: int, rate: float, cuts: list[np.ndarray]) -> tuple[list[Tree], np.ndarray]:
    first_loss = np.zeros(4)
    for level in range(max(depth, 1)):
        best, loss = _level(rows, r)
        if not level:
            first_loss = loss
        following: list[list[int]] = [[] for _ in r.growing]
        for k, tree in enumerate(r.growing):
            for node in r.active[k]:
                f = best.get((k, node))
                if f is None:
                    continue
                tree.value[node], tree.cover[node] = float(r.penalties.weight(f.g, f.h)) * rate, f.h
                if f.bin < 0 or depth < 1:
                    continue
                tree.feature[node], tree.bin[node], tree.gain[node] = f.feature, f.bin, f.gain
                tree.cut[node] = float(cuts[f.feature][f.bin])
                for name, g, h in (("left", f.gl, f.hl), ("right", f.g - f.gl, f.h - f.hl)):
                    child = tree.add()
                    getattr(tree, name)[node] = child
                    tree.value[child], tree.cover[child] = float(r.penalties.weight(g, h)) * rate, h
                    following[k].append(child)
        r.active = following
        if not any(following):
            break
    return [_pruned(t, r.penalties.gamma) for t in r.growing], first_loss


def _with_margins(rows: DataFrame, r: _Round, spark: SparkSession, path: str) -> DataFrame:
    """The rows with margins that the recent trees are added to, stored."""
    n_features, trees = len(r.bins), len(r.growing)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            stored = b.column(5).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, trees)
            margin = r.margins(_bin_matrix(b.column(1), n_features, r.kind), stored)
            ends = np.arange(0, margin.size + 1, trees, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.ListArray.from_arrays(ends, np.ascontiguousarray(margin).ravel())], b.schema.names)

    rows.mapInArrow(each, rows.schema).write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@dataclass
class BoostedTrees:
    """A fitted model: trees of each round, one for each class (one alone for two classes and for values), and the margins they start at."""

    rounds: list[list[Tree]]
    base: list[float]
    task: str
    classes: int
    numFeatures: int
    history: list[dict[str, float]] = field(default_factory=list)  # loss and valid_loss after each round
    best_round: int | None = None

    @property
    def getNumTrees(self) -> int:
        return len(self.rounds)

    @property
    def used(self) -> np.ndarray:
        """Features that the trees cut by."""
        return np.unique([f for trees in self.rounds for t in trees for f in t.feature if f >= 0]).astype(np.int64)

    @property
    def featureImportances(self):
        """Mean gain of a feature's cuts, adding up to one."""
        total, cuts = np.zeros(self.numFeatures), np.zeros(self.numFeatures)
        for trees in self.rounds:
            for t in trees:
                for f, g in zip(t.feature, t.gain, strict=True):
                    if f >= 0:
                        total[f] += g
                        cuts[f] += 1
        mean = np.divide(total, cuts, out=np.zeros_like(total), where=cuts > 0)
        return Vectors.dense(mean / mean.sum() if mean.sum() > 0 else mean)

    def predict(self, vector) -> float:
        """The prediction for one feature vector."""
        x = np.asarray(vector.toArray() if hasattr(vector, "toArray") else vector, float)[None, :]
        margin = np.asarray(self.base, float) + [sum(t[k].leaf_values(x, "cut")[0] for t in self.rounds) for k in range(len(self.base))]
        return float(margin[0]) if self.task == "regression" else float(margin[0] > 0) if self.classes <= 2 else float(margin.argmax())

    def _margin(self):
        used = self.used
        column = np.zeros(self.numFeatures, np.int64)
        column[used] = np.arange(len(used))

        def each(vectors: pa.Array) -> pa.Array:
            x = matrix(vectors, used)
            out = np.tile(np.asarray(self.base, float), (len(x), 1))
            for trees in self.rounds:
                for k, t in enumerate(trees):
                    out[:, k] += t.leaf_values(x, "cut", column)
            ends = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(ends, out.ravel())

        return F.arrow_udf(each, "array<double>")

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds prediction, and for classes rawPrediction and probability."""
        margin = self._margin()(entries("features", self.numFeatures))
        if self.task == "regression":
            return df.withColumn("prediction", F.get(margin, F.lit(0)))
        out = df.withColumn("__margin", margin)
        m = F.col("__margin")
        if self.classes <= 2:
            p = 1 / (1 + F.exp(-F.get(m, F.lit(0))))
            raw, probability = F.array(-F.get(m, F.lit(0)), F.get(m, F.lit(0))), F.array(1 - p, p)
        else:
            e = F.transform(m, lambda x: F.exp(x - F.array_max(m)))
            raw, probability = m, F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))
        best = F.array_position(probability, F.array_max(probability)).cast("double") - 1
        return out.withColumns({"rawPrediction": array_to_vector(raw), "probability": array_to_vector(probability), "prediction": best}).drop("__margin")

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, k, n, *[getattr(t, c)[n] for c in _NODE]) for i, trees in enumerate(self.rounds) for k, t in enumerate(trees) for n in range(len(t.feature))]
        spark.createDataFrame(rows, f"round int, class int, node int, {', '.join(f'{c} {t}' for c, t in _NODE.items())}").write.mode("overwrite").parquet(f"{path}/nodes")
        about = {"base": self.base, "task": self.task, "classes": self.classes, "features": self.numFeatures, "rounds": len(self.rounds), "history": self.history, "best_round": self.best_round}
        spark.createDataFrame([(json.dumps(about),)], "document string").write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        about = json.loads(spark.read.parquet(f"{path}/about").first().document)
        rounds: list[list[Tree]] = [[Tree(*[[] for _ in _NODE]) for _ in about["base"]] for _ in range(about["rounds"])]
        for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").collect():
            for c in _NODE:
                getattr(rounds[r["round"]][r["class"]], c).append(r[c])
        return cls(rounds, about["base"], about["task"], about["classes"], about["features"], about["history"], about["best_round"])


# columns of a stored node, in the order of a tree's fields
_NODE = {"feature": "int", "bin": "int", "cut": "double", "left": "int", "right": "int", "value": "double", "cover": "double", "gain": "double"}


@dataclass(frozen=True)
class Boosting:
    """The unfitted model."""

    task: str
    classes: int
    params: dict[str, Any]
    seed: int = 42
    held_out: Any = None
    patience: int | None = None
    weight: str | None = None  # column that says how many times a row counts

    def _of(self, name: str):
        return self.params[name] if self.params.get(name) is not None else DEFAULTS[name]

    def getMaxIter(self) -> int:
        return int(self._of("n_estimators"))

    def getStepSize(self) -> float:
        return float(self._of("learning_rate"))

    def getMaxDepth(self) -> int:
        return int(self._of("max_depth"))

    def fit(self, df: DataFrame) -> BoostedTrees:
        return fit_boosted(df, self.task, self.classes, self.params, self.seed, self.held_out, self.patience, self.weight)


def fit_boosted(df: DataFrame, task: str, classes: int, params: dict[str, Any], seed: int = 42, held_out=None, patience: int | None = None, weight: str | None = None) -> BoostedTrees:
    """Boost ``df`` (features, label). ``held_out`` marks rows that only measure the loss after each round; with ``patience``, boosting
    stops after so many rounds without a better one and keeps the rounds up to the best. A row counts as many times as the column ``weight`` says."""
    p = {**DEFAULTS, **{k: v for k, v in params.items() if v is not None}}
    spark = df.sparkSession
    cuts = find_cuts(df, int(p["max_bins"]), weight)
    if not cuts:
        raise ValueError("no rows to fit on")
    bins = [len(c) + 1 for c in cuts]
    trees = classes if task == "classification" and classes > 2 else 1
    folder = new_path(spark, "boosting")
    binned = _binned(df, cuts, seed, held_out, weight)
    binned.write.parquet(f"{folder}/bins")
    binned = spark.read.schema(binned.schema).parquet(f"{folder}/bins")
    if p["base_score"] is not None:
        score = float(p["base_score"])
        base = [float(np.log(score / (1 - score)))] if task == "classification" and trees == 1 else [score] * trees
    else:
        base = [float(binned.where("NOT held").agg(F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).first()[0] or 0.0)] if task == "regression" else [0.0] * trees
    rows = binned.withColumn("margin", F.array(*[F.lit(b) for b in base]))
    rng = np.random.default_rng(seed)
    kind = np.uint8 if max(bins) <= 256 else np.uint16
    penalties = Penalties(float(p["reg_lambda"]), float(p["reg_alpha"]), float(p["gamma"]), float(p["min_child_weight"]))
    model = BoostedTrees([], base, task, classes, len(cuts))
    recent: list[list[Tree]] = []
    best: tuple[float, int] = (np.inf, 0)

    def state(growing, active, number) -> _Round:
        n = max(1, round(len(cuts) * float(p["colsample_bytree"])))
        columns = np.arange(len(cuts)) if n >= len(cuts) else np.sort(rng.choice(len(cuts), n, replace=False))
        return _Round(task, classes, base, recent, growing, active, columns, bins, kind, penalties, float(p["subsample"]), number, seed)

    def note(loss: np.ndarray) -> bool:
        """Whether to stop."""
        nonlocal best
        done = len(model.rounds)
        if done:
            entry = {"loss": loss[2] / max(loss[3], 1)} | ({"valid_loss": loss[0] / loss[1]} if loss[1] else {})
            model.history.append({k: float(v) for k, v in entry.items()})
        if not loss[1]:
            return False
        value = float(loss[0] / loss[1])
        if done and value < best[0]:
            best = value, done
        return patience is not None and done - best[1] >= patience and done > 0

    for number in range(int(p["n_estimators"])):
        r = state([Tree() for _ in range(trees)], [[0] for _ in range(trees)], number)
        grown, loss = _grown(rows, r, int(p["max_depth"]), float(p["learning_rate"]), cuts)
        if note(loss):
            break
        model.rounds.append(grown)
        recent.append(grown)
        if len(recent) == STORED:
            rows = _with_margins(rows, state(grown, [[] for _ in grown], number), spark, f"{folder}/margins-{number}")
            recent = []
    else:
        _, loss = _level(rows, state([Tree() for _ in range(trees)], [[] for _ in range(trees)], len(model.rounds)))
        note(loss)
    if patience is not None and best[1]:
        model.best_round = best[1]
        model.rounds = model.rounds[: best[1]]
    return model
