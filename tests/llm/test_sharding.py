import itertools
import zlib

from pyspark.sql import functions as F

from tablewright.llm import sharding
from tablewright.llm.queries import QUERIES


def test_fewest_bytes():
    """Against all ways to send whole units."""
    sizes, rooms = {0: 5, 1: 0, 2: 4}, [3, 3, 3]
    plan = sharding.plan_transfers(sizes, rooms)
    moved = sum(t.amount for t in plan if t.source != t.target)
    ways = [a for a in itertools.product(range(6), repeat=9) if all(sum(a[3 * i : 3 * i + 3]) == sizes[i] for i in range(3)) and all(sum(a[j::3]) <= rooms[j] for j in range(3))]
    assert moved == min(sum(v for k, v in enumerate(a) if k // 3 != k % 3) for a in ways)
    for j in range(3):
        assert sum(t.amount for t in plan if t.target == j) <= rooms[j]
    assert sharding.affected(plan) == [0, 1, 2]
    assert sharding.affected(sharding.plan_transfers({0: 3, 1: 3}, [3, 3])) == []


def test_send_costs_decide():
    plan = sharding.plan_transfers({0: 4, 1: 4}, [4, 4, 2], {0: 5, 1: 1})
    assert all(t.source == t.target for t in plan)
    plan = sharding.plan_transfers({5: 2, 6: 2}, [2, 2], {5: 5, 6: 1})
    assert sum(t.cost for t in plan) == 12


def test_odd_rows(odd_docs, no_docs):
    args = (F.col("shard"), 4, sharding.text_size(), [F.col("doc_id"), F.col("text")])
    out = sharding.reshard(odd_docs, *args)
    assert out.columns[-4:] == ["old_shard", "shard", "slot", "moved"] and out.count() == odd_docs.count()
    for s in out.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("slots")).collect():
        assert s.slots == list(range(len(s.slots)))
    assert sharding.reshard(no_docs, *args).count() == 0


def test_query(spark):
    rows = QUERIES["op1_sharding"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sums = [0] * 8
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        sums[r.shard] += r.size
    assert max(sums) - min(sums) <= max(r.size for r in rows)
