"""Near duplicates by circulant MinHash: groups of documents that share four fifths of their four-word shingles.

A document is the set of its shingles' hashes; equal sets are one class. One permutation lays the shingles on a circle of 2 ** 32
places; a second one orders the places. Coordinate k of a signature is the smallest place of the set in the second order after
all places have moved k steps round the circle: two permutations in all, one of them circularly shifted. Bands of coordinates are keys;
classes that share a key are a bucket. Every member of a bucket is compared with the bucket's smallest id: first the
signatures, then the whole sets, and what is similar enough is one group from then on. Buckets that still hold several groups are
gone through once more: members whose signature is near that of a member of another group come together with their whole sets in
one task for a bucket, which compares sets across groups and gives only the links that join two groups. So a bucket of m members
gives at most m rows in every step, however many of its pairs are similar, and no pair that shares a band goes untested but those that
are in one group already.

A pair of similarity 0.8 shares none of the 36 bands of 5 with a probability of 6e-7; its signatures then look too different with
less than 1e-6. Links are always confirmed on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import linking
from tablewright.llm.base import cut_lineage, stored
from tablewright.llm.bytewords import mix
from tablewright.llm.jaccard import _id_filter, _passes, components
from tablewright.llm.linking import PERCENT

SHINGLE = 4
BANDS, ROWS = 36, 5
COORDINATES = BANDS * ROWS
#: Coordinates whose lowest bytes are equal, at least, in signatures that are looked at further: 5.5 deviations below what 0.8 expects.
ALIKE = 114
STEP = np.uint32(0x9E3779B1)  # one step round the circle
STRETCH = 1 << 15  # shingles that go through the second permutation at once
PART = 16 << 20  # bytes of the sets of a bucket that one task holds; larger buckets are pairs of parts

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63], np.uint64)
_SEED = np.uint64(0x51AFD7ED558CCD)


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    return linking.sets_of(texts, SHINGLE)


def _second_permutation(x: np.ndarray, held: np.ndarray) -> None:
    """A bijection of 32-bit numbers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=held)
        np.bitwise_xor(x, held, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=held)
    np.bitwise_xor(x, held, out=x)


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of 32-bit coordinates for every set; those of an empty set are all the largest number."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, np.uint32)
    if not sizes.sum():
        return out
    circle = (mix(np.concatenate(sets) ^ _SEED) >> np.uint64(32)).astype(np.uint32)  # the first permutation
    owner = np.repeat(np.arange(len(sets)), sizes)
    for a in range(0, len(circle), STRETCH):
        places = circle[a : a + STRETCH]
        own = owner[a : a + STRETCH]
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        rows = own[heads]
        x, held = np.empty_like(places), np.empty_like(places)
        least = np.empty((coordinates, len(heads)), np.uint32)
        for k in range(coordinates):
            np.add(places, np.uint32(k * int(STEP) & 0xFFFFFFFF), out=x)
            _second_permutation(x, held)
            np.minimum.reduceat(x, heads, out=least[k])
        out[rows] = np.minimum(out[rows], least.T)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row; keys of different bands differ."""
    parts = signature.reshape(len(signature), -1, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        keys = mix(keys * _MULTIPLIERS[0] + parts[:, :, k])
    return keys


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sign): equal sets have equal keys; ``sign`` is the lowest byte of each coordinate."""

    def each(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                sets = sets_of(part.column(1))
                s = signatures(sets)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(s).view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
                low = np.ascontiguousarray(s.astype(np.uint8))
                keys = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
                columns = [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()), bands, pa.array([r.tobytes() for r in low], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "bands", "sign"])

    return docs.mapInArrow(each, "doc_id long, n_shingles long, set_key binary, bands array<long>, sign binary")


def _similar_size(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Signatures of equal length as rows."""
    return np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in column]) if len(column) else np.empty((0, COORDINATES), np.uint8)


def _alike(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array((_matrix(a) == _matrix(b)).sum(axis=1) >= ALIKE, pa.bool_())


def _looked_alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures do not rule a link out."""
    left = classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sign").alias("sign_a"))
    right = classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sign").alias("sign_b"))
    alike = F.arrow_udf(_alike, "boolean")
    return pairs.join(left, "a").join(right, "b").where(_similar_size("na", "nb")).where(alike("sign_a", "sign_b")).select("a", "b")


def _whole_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(i, s): the whole sets of the documents whose ids are in the columns a and b, and of a few others. Texts are not moved: a
    filter of fixed size tells which of them to make sets of."""
    wanted = _id_filter(ids)

    def each(batches):
        for b in batches:
            i = b.column(0).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(_passes(wanted, i))
            for k in range(0, len(at), 500):
                some = at[k : k + 500]
                sets = [s.tobytes() for s in sets_of(b.column(1).take(pa.array(some)))]
                yield pa.RecordBatch.from_arrays([pa.array(i[some], pa.int64()), pa.array(sets, pa.binary())], ["i", "s"])

    return stored(docs.where("i IS NOT NULL").mapInArrow(each, "i long, s binary"), "minhash-sets")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    pairs = cut_lineage(pairs)
    if pairs.isEmpty():
        return pairs
    sets = _whole_sets(pairs, docs)
    linked = F.arrow_udf(linking.confirmed, "boolean")
    found = pairs.join(sets.select(F.col("i").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("i").alias("b"), F.col("s").alias("sb")), "b")
    return found.where(linked("sa", "sb")).select("a", "b").distinct()


def _near_another_group(t: pa.Table) -> tuple | None:
    """(key, id, component, n_shingles) of the rows whose signature is near one of another group. Rows of part i meet those of part j."""
    n, group, part = (t.column(c).to_numpy() for c in ("n_shingles", "component", "part"))
    if (group == group[0]).all():
        return None
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    signs, near = _matrix(t.column("sign")), np.zeros(len(n), bool)
    # of two groups one at least is not the largest: its members look at all others
    names, counts = np.unique(group, return_counts=True)
    lookers = np.flatnonzero(group != names[counts.argmax()])
    for at in lookers.tolist():
        ok = (group != group[at]) & (100 * np.minimum(n, n[at]) >= PERCENT * np.maximum(n, n[at]))
        if i != j:
            ok &= part != part[at]
        other = np.flatnonzero(ok)
        for k in range(0, len(other), 4096):
            some = other[k : k + 4096]
            hit = some[(signs[some] == signs[at]).sum(axis=1) >= ALIKE]
            if len(hit):
                near[hit] = near[at] = True
    found = np.flatnonzero(near)
    return tuple(t.column(c).to_numpy()[found] for c in ("key", "id", "component", "n_shingles"))


def _second_look(members: DataFrame, classes: DataFrame, known: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between different groups that share a bucket. What is read more than once is stored: in one large query, the driver
    would plan every copy of it anew after each stage."""
    grouped = members.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    grouped = stored(grouped, "grouped-members")
    bounds = [F.min("component").alias("low"), F.max("component").alias("high"), linking.parts_of(F.lit(COORDINATES), PART).alias("parts")]
    undecided = grouped.groupBy("key").agg(*bounds).where("low <> high").select("key", "parts")
    rows = grouped.join(undecided, "key").join(classes.select("id", "n_shingles", "sign"), "id")
    sorted_rows = linking.dealt(rows).select("key", "i", "j", "part", "id", "component", "n_shingles", "sign").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    schema = "key long, id long, component long, n_shingles long"
    near = stored(sorted_rows.mapInArrow(linking.by_block(_near_another_group, schema), schema).distinct(), "near")
    if near.isEmpty():
        return known.sparkSession.createDataFrame([], "a long, b long")
    sets = _whole_sets(near.select(F.col("id").alias("a"), F.col("id").alias("b")), docs)
    cut = linking.in_parts(near, 8 * F.col("n_shingles"), PART).select("key", "i", "j", "part", "id", "component")
    met = cut.join(sets.select(F.col("i").alias("id"), "s"), "id").select("key", "i", "j", "part", "id", "component", "s")
    sorted_rows = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sorted_rows.mapInArrow(linking.by_block(linking.joining_links, "a long, b long"), "a long, b long").distinct()


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: its set's size, the smallest id that links reach, and whether it is that one.

    Words are stretches of anything but ASCII white space, A-Z made small; texts are taken whole. Null and empty texts have no shingles
    and link with nothing; they are kept. A row without an id has no component, links with nothing and is kept. Repeated rows stay, and each
    row is placed by its own text. Other columns play no part.
    """
    docs = df.select(F.col(id).cast("long").alias("i"), F.col(text).cast("string").alias("t"))
    signed = stored(_signed(docs), "signatures")
    able = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "sign")]
    classes = stored(able.groupBy("set_key").agg(F.min("doc_id").alias("id"), *first).drop("set_key"), "classes")

    entries = classes.select(F.explode("bands").alias("key"), "id")
    # counted before they meet: a bucket of any size is one row of this table, and the join's skewed parts can be split
    buckets = stored(entries.groupBy("key").agg(F.min("id").alias("root"), F.count("*").alias("m")).where("m > 1"), "buckets")
    members = stored(entries.join(buckets, "key"), "members")
    tries = members.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct()
    known = stored(components(_verified(_looked_alike(tries, classes), docs)), "groups")
    # in buckets of two, the tries hold the only pair
    more = _second_look(members.where("m > 2").select("key", "id"), classes, known, docs)
    known = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    named = able.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    placed = named.join(known, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    # a set's rows may be a third of all: a plain join, whose skewed parts Spark splits
    joined = signed.select("doc_id", "n_shingles", "set_key").join(placed, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
