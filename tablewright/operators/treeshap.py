"""Shapley values of tree ensembles, path-dependent (Lundberg et al., 2020), by polynomials along the paths (Yu et al., 2022).

Within a leaf the Shapley weights of coalitions are integrals over t in [0, 1] of t^s (1-t)^(d-1-s), so a leaf's game is the
integral of a product over the features of its path: pass * t + share * (1 - t), where ``share`` is the part of the training rows that
passes. A walk down the tree carries the product for a batch of rows at the points of a Gauss rule that is exact for its degree; on the
way back the sums of the leaves below give every edge its part. A node is visited once, however many leaves lie below.

Trees are rows of a table, packed on the cluster from the stored nodes. They reach the tasks by the same shuffle as the rows to be
explained, ahead of them; the driver sees none of them. Trees of few nodes together go to the tasks as constants, and no row is shuffled.
Only the columns that the trees cut by are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.storage import new_path
from tablewright.functions.vectors import entries, matrix
from tablewright.operators.boosting import BoostedTrees

MAX_NODES = 2_000_000  # of the trees that a task holds, some 200 MB; more trees take more passes
CONSTANT_NODES = 20_000  # trees of so many nodes together, some 2 MB, are constants
KNOWN_SHARES = 1 << 20  # numbers that a task remembers of rows it has explained
ROWS = 512  # that walk a tree together
_NODE = "struct<node: int, feature: int, cut: double, categories: array<double>, left: int, right: int, cover: double, value: array<double>>"


@dataclass
class PackedTree:
    """Arrays over a tree's nodes. ``of_class`` is the class that the values belong to, -1 if they hold one for each class."""

    of_class: int
    feature: np.ndarray
    cut: np.ndarray
    categories: list
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray
    value: np.ndarray  # nodes by classes

    def points(self) -> tuple[np.ndarray, np.ndarray]:
        """Gauss points and weights on [0, 1], exact for the products along every path."""
        most, stack = 1, [(0, frozenset())]
        while stack:
            at, seen = stack.pop()
            if self.feature[at] < 0:
                most = max(most, len(seen))
            else:
                below = seen | {int(self.feature[at])}
                stack += [(int(self.left[at]), below), (int(self.right[at]), below)]
        nodes, weights = np.polynomial.legendre.leggauss((most + 1) // 2)
        return (nodes + 1) / 2, weights / 2

    def goes_left(self, at: int, x: np.ndarray) -> np.ndarray:
        """Of the values of the node's feature."""
        return np.isin(x, self.categories[at]) if self.categories[at] is not None else x <= self.cut[at]

    def add_shares(self, x: np.ndarray, column: dict[int, int], phi: np.ndarray) -> None:
        """Adds each row's Shapley values to ``phi`` (rows, classes, columns of x)."""
        t, w = self.points()
        rest = 1 - t
        out = phi if self.of_class < 0 else phi[:, self.of_class : self.of_class + 1]

        def walk(at: int, product: np.ndarray, path: dict) -> np.ndarray:
            """Sums over the leaves below: rows, points, classes."""
            f = int(self.feature[at])
            if f < 0:
                return product[:, :, None] * self.value[at]
            left = self.goes_left(at, x[:, column[f]])
            old, total = path.get(f), 0.0
            for child, passes in ((int(self.left[at]), left), (int(self.right[at]), ~left)):
                ok, share = passes.astype(float), self.cover[child] / self.cover[at]
                before = product
                if old:
                    ok, share, before = ok * old[0], share * old[1], product / old[2]
                factor = ok[:, None] * t + share * rest
                below = walk(child, before * factor, {**path, f: (ok, share, factor)})
                out[:, :, column[f]] += (ok - share)[:, None] * np.einsum("rtc,rt->rc", below, w / factor)
                if old:  # these leaves count with the lower edge of the feature, not with the upper one
                    out[:, :, column[f]] -= (old[0] - old[1])[:, None] * np.einsum("rtc,rt->rc", below, w / old[2])
                total = total + below
            return total

        walk(0, np.ones((len(x), len(t))), {})


def _nodes_of_spark(trained, spark: SparkSession) -> tuple[DataFrame, int]:
    """(tree, of_class, node) rows of a Spark ML forest from its own stored form, values over the number of trees."""
    path = new_path(spark, "trees")
    trained.model.write().overwrite().save(path)
    n = trained.model.getNumTrees
    stats = F.col("impurityStats")
    of_classes = trained.learner.task == "classification"
    value = F.transform(stats, lambda v: v / F.aggregate(stats, F.lit(0.0), lambda a, b: a + b) / n) if of_classes else F.array(F.col("prediction") / n)
    split, inner = F.col("split"), F.col("leftChild") >= 0
    # numbers of rows: by weight, where a row stands for several
    cover = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b) if of_classes else F.get(stats, F.lit(0))
    categorical = inner & (split["numCategories"] >= 0)
    node = F.struct(
        F.col("id").alias("node"), F.when(inner, split["featureIndex"]).otherwise(-1).alias("feature"),
        F.when(inner & ~categorical, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).otherwise(0.0).alias("cut"),
        F.when(categorical, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), cover.alias("cover"), value.alias("value"),
    )
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    return nodes.select(F.col("treeID").alias("tree"), F.lit(-1).alias("of_class"), node.cast(_NODE).alias("node")), trained.model.numClasses if of_classes else 1


def _nodes_of_boosted(model: BoostedTrees, spark: SparkSession) -> tuple[DataFrame, int]:
    path = new_path(spark, "trees")
    model.save(spark, path)
    node = F.struct("node", "feature", "cut", F.lit(None).cast("array<double>").alias("categories"), "left", "right", "cover", F.array("value").alias("value"))
    trees = len(model.base)
    stored = spark.read.parquet(f"{path}/nodes")
    return stored.select((F.col("round") * trees + F.col("class")).alias("tree"), F.col("class").alias("of_class"), node.cast(_NODE).alias("node")), trees


def _packed(nodes: DataFrame) -> DataFrame:
    """One row a tree: (tree, of_class, nodes in order)."""
    return nodes.groupBy("tree", "of_class").agg(F.array_sort(F.collect_list("node")).alias("nodes"))


def _unpacked(of_class: int, nodes: pa.Scalar) -> PackedTree:
    n = nodes.values
    column = dict(zip([f.name for f in n.type], n.flatten(), strict=True))
    plain = {k: column[k].to_numpy(zero_copy_only=False) for k in ("feature", "cut", "left", "right", "cover")}
    value = column["value"].flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1)
    categories = [c.as_py() for c in column["categories"]]
    return PackedTree(of_class, plain["feature"], plain["cut"], categories, plain["left"], plain["right"], plain["cover"], value)


def shares(trees: Sequence[PackedTree], x: np.ndarray, column: dict[int, int], classes: int, known: dict[bytes, np.ndarray] | None = None) -> np.ndarray:
    """Sums over the trees for every row; equal rows are explained once, and not again if they are ``known`` from other rows of the task."""
    different, back = np.unique(x, axis=0, return_inverse=True)
    phi = np.zeros((len(different), classes, x.shape[1]))
    known = {} if known is None else known
    keys = [r.tobytes() for r in different]
    new = []
    for i, k in enumerate(keys):
        if k in known:
            phi[i] = known[k]
        else:
            new.append(i)
    for at in range(0, len(new), ROWS):
        some = new[at : at + ROWS]
        part = np.zeros((len(some), classes, x.shape[1]))
        for t in trees:
            t.add_shares(different[some], column, part)
        phi[some] = part
    if (len(known) + len(new)) * classes * x.shape[1] > KNOWN_SHARES:
        known.clear()
    if len(new) * classes * x.shape[1] <= KNOWN_SHARES:
        known.update((keys[i], phi[i].copy()) for i in new)
    return phi[back.ravel()]


def _mean_value(nodes: DataFrame, classes: int) -> list[float]:
    """The trees' mean over their training rows, per class: a node's cover over the root's, times its value, over all leaves."""
    roots = nodes.where("node.node = 0").select("tree", F.col("node.cover").alias("root"))
    leaves = nodes.where("node.feature < 0").join(roots, "tree")
    parts = leaves.select(F.col("node.cover") / F.col("root"), "of_class", F.posexplode("node.value").alias("k", "v")).toDF("share", "of_class", "k", "v")
    sums = parts.groupBy(F.greatest("of_class", "k").alias("c")).agg(F.sum(F.col("share") * F.col("v")).alias("s")).collect()
    out = [0.0] * classes
    for r in sums:
        out[r.c] += r.s
    return out


def tree_contributions(trained, df: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, list[float], int]:
    """(keep..., class, phi of all features), the base value of every class, and the number of classes."""
    spark = df.sparkSession
    boosted = isinstance(trained.model, BoostedTrees)
    nodes, classes = _nodes_of_boosted(trained.model, spark) if boosted else _nodes_of_spark(trained, spark)
    path = new_path(spark, "packed-trees")
    _packed(nodes).write.parquet(path)
    trees = spark.read.parquet(path)
    sizes = sorted((r.tree, r.n) for r in trees.select("tree", F.size("nodes").alias("n")).collect())
    used = sorted(r.f for r in nodes.select(F.col("node.feature").alias("f")).where("f >= 0").distinct().collect())
    base = _mean_value(nodes, classes)
    if boosted:
        base = [b + s for b, s in zip(trained.model.base, base, strict=True)]
    groups: list[list[int]] = [[]]
    held = 0
    for tree, n in sizes:
        if groups[-1] and held + n > MAX_NODES:
            groups.append([])
            held = 0
        groups[-1].append(tree)
        held += n
    names = [f"__k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keep, names, strict=True)], entries("features", trained.n_features).alias("__x"), F.array().cast("array<double>").alias("__phi"))
    if held <= CONSTANT_NODES and len(groups) == 1:
        packed = trees.orderBy("tree").select("of_class", "nodes").toArrow().to_batches()
        rows = _add_constant(rows, [_unpacked(c.as_py(), n) for b in packed for c, n in zip(b.column(0), b.column(1), strict=True)], used, classes)
        groups = []
    for group in groups:
        rows = _add(rows, trees.where(F.col("tree").isin(group)), used, classes)
        if group is not groups[-1]:  # the next pass starts from stored sums, so a task holds one group of trees
            path = new_path(spark, "shares")
            rows.write.parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
    width, k = trained.n_features, len(used)
    place = [-1] * width
    for i, f in enumerate(used):
        place[f] = i
    places = F.array(*[F.lit(p) for p in place])

    def of_class(c: Column) -> Column:
        return F.transform(places, lambda p: F.when(p < 0, 0.0).otherwise(F.get("__phi", c * k + p)))

    parts = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), of_class)
    out = rows.select(*[F.col(n).alias(o) for n, o in zip(names, keep, strict=True)], F.posexplode(parts).alias("class", "phi"))
    return out, base, classes


def _list_of(phi: np.ndarray, size: int) -> pa.ListArray:
    ends = np.arange(0, len(phi) * size + 1, size, dtype=np.int32) if size else np.zeros(len(phi) + 1, np.int32)
    return pa.ListArray.from_arrays(ends, np.ascontiguousarray(phi).ravel())


def _add_constant(rows: DataFrame, trees: list[PackedTree], used: list[int], classes: int) -> DataFrame:
    """``_add`` for few nodes: rows are explained where they are."""
    column, wanted, size = {f: i for i, f in enumerate(used)}, np.array(used, np.int64), classes * len(used)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        for b in batches:
            phi = shares(trees, matrix(b.column("__x"), wanted), column, classes, known).reshape(b.num_rows, size)
            yield pa.RecordBatch.from_arrays([_list_of(phi, size) if c == "__phi" else b.column(c) for c in b.schema.names], b.schema.names)

    return rows.mapInArrow(add, rows.schema)


def _add(rows: DataFrame, trees: DataFrame, used: list[int], classes: int) -> DataFrame:
    """The rows with the trees' shares added to ``__phi``: classes after one another, each with the used features."""
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumns({"__part": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int"), "__first": F.lit(1)})
    everywhere = trees.withColumns({"__part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "__first": F.lit(0)})
    both = everywhere.unionByName(dealt, allowMissingColumns=True)
    column, wanted = {f: i for i, f in enumerate(used)}, np.array(used, np.int64)
    schema, names = rows.schema, rows.columns
    size = classes * len(used)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[PackedTree] = []
        known: dict[bytes, np.ndarray] = {}
        part = None
        for batch in batches:
            here, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__part", "__first"))
            edges = [0, *(np.flatnonzero((here[1:] != here[:-1]) | (first[1:] != first[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if here[a] != part:
                    held, known, part = [], {}, here[a]
                some = batch.slice(a, b - a)
                if not first[a]:
                    held += [_unpacked(c.as_py(), n) for c, n in zip(some.column("of_class"), some.column("nodes"), strict=True)]
                    continue
                # a slice's lists start anywhere; one copy makes them plain
                some = pa.Table.from_batches([some]).combine_chunks().to_batches()[0]
                phi = shares(held, matrix(some.column("__x"), wanted), column, classes, known).reshape(b - a, size)
                before = some.column("__phi").flatten().to_numpy(zero_copy_only=False)
                if before.size:
                    phi = phi + before.reshape(b - a, size)
                sums = _list_of(phi, size)
                yield pa.RecordBatch.from_arrays([sums if c == "__phi" else some.column(c) for c in names], names)

    return both.repartition(parts, "__part").sortWithinPartitions("__part", "__first").mapInArrow(add, schema)
