"""Move the fewest bytes from old shards to new ones.

The driver sees one number per shard. A minimum-cost flow from old sizes to new capacities decides how many bytes
every old shard keeps and how many it sends where; the cluster then cuts the shards' rows at those bytes. Rows of a shard
have a fixed order (large rows, then the others, each by hash), so a cut falls among small rows and a size differs from its
capacity by less than two of them. What a shard keeps is the first part of its order; what all shards give up stands on one line, on
which the receiving shards take adjoining stretches. Only shards that give or get rows are written again.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 4096  # the rows of a shard are ordered within so many blocks, in as many tasks


@dataclass(frozen=True)
class Transfer:
    source: int
    target: int
    amount: int
    cost: float


class FlowNetwork:
    """Minimum-cost flow by successive shortest paths with node potentials. Integer capacities, costs of 0 or more."""

    def __init__(self, n: int):
        self.heads: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[float] = []

    def arc(self, a: int, b: int, capacity: int, cost: float) -> int:
        """The number of the arc; its flow is what ``flow`` gives for it."""
        for x, y, room, price in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.heads[x].append(len(self.to))
            self.to.append(y)
            self.left.append(room)
            self.cost.append(price)
        return len(self.to) - 2

    def flow(self, arc: int) -> int:
        return self.left[arc ^ 1]

    def solve(self, source: int, sink: int) -> int:
        n, sent = len(self.heads), 0
        potential = [0.0] * n
        while True:
            far, via = [float("inf")] * n, [-1] * n
            far[source] = 0
            queue = [(0.0, source)]
            while queue:
                d, x = heapq.heappop(queue)
                if d > far[x]:
                    continue
                for e in self.heads[x]:
                    y, new = self.to[e], d + self.cost[e] + potential[x] - potential[self.to[e]]
                    if self.left[e] > 0 and new < far[y] - 1e-12:
                        far[y], via[y] = new, e
                        heapq.heappush(queue, (new, y))
            if via[sink] < 0:
                return sent
            potential = [p + min(f, far[sink]) for p, f in zip(potential, far, strict=True)]
            room, x = None, sink
            while x != source:
                room = self.left[via[x]] if room is None else min(room, self.left[via[x]])
                x = self.to[via[x] ^ 1]
            x = sink
            while x != source:
                self.left[via[x]] -= room
                self.left[via[x] ^ 1] += room
                x = self.to[via[x] ^ 1]
            sent += room


def equal_capacities(total: int, n: int) -> list[int]:
    """``total`` in ``n`` whole parts that differ by one at most."""
    return [total * (i + 1) // n - total * i // n for i in range(n)]


def plan_transfers(sizes: dict[int, int], capacities: list[int], send_cost: dict[int, float] | None = None) -> list[Transfer]:
    """The transfers (kept amounts included, at cost 0) that move the fewest bytes from ``sizes`` to ``capacities``.

    Shard ``i`` may keep what fits into capacity ``i`` at no cost; every byte that leaves costs 1, or ``send_cost`` of
    its shard. What leaves meets in one hub, so the network has as many arcs as there are shards, not pairs of them.
    """
    old, n = sorted(sizes), len(capacities)
    if sum(sizes.values()) > sum(capacities):
        raise ValueError("the capacities do not hold the data")
    place = {s: 2 + k for k, s in enumerate(old)}
    hub = 2 + len(old)
    net = FlowNetwork(hub + 1 + n)
    kept, leaving, arriving = {}, {}, {}
    for s in old:
        net.arc(0, place[s], sizes[s], 0)
        if 0 <= s < n:
            kept[s] = net.arc(place[s], hub + 1 + s, sizes[s], 0)
        leaving[s] = net.arc(place[s], hub, sizes[s], (send_cost or {}).get(s, 1))
    for j, room in enumerate(capacities):
        arriving[j] = net.arc(hub, hub + 1 + j, room, 0)
        net.arc(hub + 1 + j, 1, room, 0)
    net.solve(0, 1)
    out = [Transfer(s, s, net.flow(e), 0) for s, e in kept.items() if net.flow(e)]
    wanted = [[j, net.flow(e)] for j, e in arriving.items() if net.flow(e)]
    for s in old:  # take the hub's flow apart, in order
        rest = net.flow(leaving[s])
        while rest:
            j, amount = wanted[0][0], min(rest, wanted[0][1])
            out.append(Transfer(s, j, amount, amount * (send_cost or {}).get(s, 1)))
            rest -= amount
            wanted[0][1] -= amount
            if not wanted[0][1]:
                wanted.pop(0)
    return out


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text (none for null) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _chosen(key: Column, values: dict[int, int], default: int = 0) -> Column:
    """The value of a shard, as a constant map: it has one entry per shard."""
    if not values:
        return F.lit(default).cast("long")
    pairs = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    return F.coalesce(pairs[key], F.lit(default).cast("long"))


def reshard(df: DataFrame, old: Column, n_new: int, size: Column, order: list[Column], capacities: list[int] | None = None) -> DataFrame:
    """``df`` with ``old_shard``, ``shard`` (0 to ``n_new - 1``), ``slot`` (gapless from 0 in each shard) and ``moved``.

    ``size`` is a row's size (1 or more), ``order`` columns that tell rows apart (their hashes order rows); rows
    equal in all of them follow each other in any order. A null ``old`` counts as shard 0. Columns with the four names are replaced. Rows are never
    brought together by shard: they are ordered within BLOCKS parts of it, and a part's place is a sum over part sizes.
    """
    base = df.withColumns({"old_shard": F.coalesce(old.cast("int"), F.lit(0)), "_size": size})
    n, octave = F.count("*").alias("n"), F.floor(F.log2("_size")).cast("int")
    first = base.groupBy("old_shard", octave.alias("octave")).agg(F.sum("_size").alias("bytes"), n).collect()  # at most 40 per shard
    sizes: dict[int, int] = {}
    for r in first:
        sizes[r.old_shard] = sizes.get(r.old_shard, 0) + r.bytes
    total, rows = sum(sizes.values()), sum(r.n for r in first)
    capacities = capacities or equal_capacities(total, n_new)
    plan = plan_transfers(sizes, capacities)
    quota = {t.source: t.amount for t in plan if t.source == t.target}

    h, tie = F.xxhash64(*order), F.xxhash64(F.lit("tie"), *order)  # of their own, so that long texts stay out of the passes that only place rows
    large = F.col("_size") >= 2 * max(1, total // max(1, rows))
    placed = base.withColumns({"_h": h, "_tie": tie, "_block": F.when(large, 0).otherwise(BLOCKS) + F.shiftrightunsigned(h, 64 - BLOCKS.bit_length() + 1).cast("int")})
    blocks = placed.groupBy("old_shard", "_block").agg(F.sum("_size").alias("bytes"), n)
    before = Window.partitionBy("old_shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("old_shard", "_block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("bytes", "n")])
    inside = Window.partitionBy("old_shard", "_block").orderBy("_h", "_tie")
    run = inside.rowsBetween(Window.unboundedPreceding, -1)
    lined = placed.withColumns({"_at": F.coalesce(F.sum("_size").over(run), F.lit(0)), "_row": F.row_number().over(inside) - 1})
    lined = lined.join(blocks, ["old_shard", "_block"])
    lined = lined.withColumns({"_at": F.col("_at") + F.col("_bytes"), "_row": F.col("_row") + F.col("_n")})
    stays = 2 * F.col("_at") + F.col("_size") <= 2 * _chosen(F.col("old_shard"), quota)
    lined = lined.withColumn("_stays", stays)

    kept_bytes, kept_rows, gone_bytes, gone_rows = ({} for _ in range(4))
    for r in lined.groupBy("old_shard", "_stays").agg(F.sum("_size").alias("bytes"), n).collect():  # two per shard
        (kept_bytes if r._stays else gone_bytes)[r.old_shard] = r.bytes
        (kept_rows if r._stays else gone_rows)[r.old_shard] = r.n
    starts, row_starts, at, row_at = {}, {}, 0, 0
    for s in sorted(sizes):  # the line of what is given up
        starts[s], row_starts[s] = at - kept_bytes.get(s, 0), row_at - kept_rows.get(s, 0)
        at, row_at = at + gone_bytes.get(s, 0), row_at + gone_rows.get(s, 0)
    ends, end = [], 0
    for j, room in enumerate(capacities):
        end += max(0, room - kept_bytes.get(j, 0))
        ends.append(end)
    place, row_place = F.col("_at") + _chosen(F.col("old_shard"), starts), F.col("_row") + _chosen(F.col("old_shard"), row_starts)
    last = max((j for j in range(len(capacities)) if ends[j] > (ends[j - 1] if j else 0)), default=0)
    target = F.lit(last)
    for j in reversed([j for j in range(last) if ends[j] > (ends[j - 1] if j else 0)]):
        target = F.when(2 * place + F.col("_size") <= 2 * ends[j], F.lit(j)).otherwise(target)
    lined = lined.withColumns({"shard": F.when(F.col("_stays"), F.col("old_shard")).otherwise(target).cast("int"), "_line": row_place})
    firsts = {r.shard: r.line for r in lined.where(~F.col("_stays")).groupBy("shard").agg(F.min("_line").alias("line")).collect()}  # one per shard
    shift = {j: kept_rows.get(j, 0) - line for j, line in firsts.items()}
    slot = F.when(F.col("_stays"), F.col("_row")).otherwise(F.col("_line") + _chosen(F.col("shard"), shift)).cast("long")
    out = lined.withColumns({"slot": slot, "moved": F.col("shard") != F.col("old_shard")})
    return out.select(*[c for c in df.columns if c not in ("old_shard", "shard", "slot", "moved")], "old_shard", "shard", "slot", "moved")


def affected(plan: list[Transfer]) -> list[int]:
    """Shards whose files change: those that give or get rows."""
    return sorted({s for t in plan if t.source != t.target and t.amount for s in (t.source, t.target)})


def write_shards(resharded: DataFrame, folder: str, only: list[int] | None = None) -> None:
    """Write ``folder/shard=K`` for the shards in ``only`` (all by default); the files of the others stay as they are."""
    rows = resharded if only is None else resharded.where(F.col("shard").isin(only))
    rows.drop("old_shard", "moved").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(folder)


def read_shards(spark, folder: str, columns: str) -> DataFrame:
    """The rows of all shards; ``columns`` is the schema besides ``shard`` and ``slot``, so that a folder without rows can be read."""
    return spark.read.schema(f"{columns}, slot long, shard int").parquet(folder)
