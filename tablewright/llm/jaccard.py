"""Self-join of documents on the Jaccard similarity of their word shingles, and its connected groups.

A document is the set of hashes of its shingles. Equal sets are one class. Two classes of similarity T or more share one
of the first ``n - ceil(T n) + 1`` shingles of both in any common order, so classes meet in the blocks of those shingles; the
order puts very common shingles last. A block is a *signature tree*: its leaves are classes with a token bitmap and a size, its
nodes the OR of the bitmaps below and their size range. Two nodes whose bitmaps and sizes cannot reach the needed overlap
are dropped with everything below them; so are nodes that already lie in one group. The block's root class is tried
first (that alone settles copies of one text). Then dual traversals of the trees find the pairs that are left; of each block only
their members go on, a pair's in the first block that it shares, and come together with their whole sets in one task for a block, which
gives the links that join two groups. A block of m classes gives at most m rows in every step, however many of its pairs are similar.
No link between different sets is lost, no pair inside a known group is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import cut_lineage, no_cache, stored
from tablewright.llm.bytewords import column_bytes, mix
from tablewright.llm.linking import PERCENT, by_block, confirmed, in_parts, joining_links, sets_of

SHINGLE = 5
BITMAP_WORDS = 16  # 1,024 bits
LEAF, FANOUT = 64, 4
BLOCK = 1024  # classes of one tree; larger blocks are pairs of trees
SALTS = 32
PART = 16 << 20  # bytes of the sets of a block that one task holds; larger blocks are pairs of parts
#: Shingles are called common by the count in one document of SAMPLED; there are at most MOST_COMMON of them. Which ones are
#: called common changes the order in which shingles are tried, and so the work, but never the result.
SAMPLED, COMMON_COUNT, MOST_COMMON = 16, 12, 500_000
FILTER_WORDS = 1 << 18  # of 64 bits; what passes this filter of ids is looked at exactly afterwards

ROWS, PAIRS = 500, 10_000  # texts that are made sets of together, and pairs whose bitmaps are compared together
ENTRIES = 1 << 16  # entries that are made together, but for one class that has more


def prefix_size(n: int) -> int:
    """So many first shingles of a set of n hold one of any set of the similarity asked for."""
    return n - (PERCENT * n + 99) // 100 + 1


def bitmap(s: np.ndarray) -> np.ndarray:
    """Two bits or more for each shingle, in a power of two of words, BITMAP_WORDS at least."""
    words = max(BITMAP_WORDS, 1 << max(0, (len(s) - 1) // 32).bit_length())
    at = s >> np.uint64(17)  # other bits than those that order shingles
    out = np.zeros(words, np.uint64)
    np.bitwise_or.at(out, ((at >> np.uint64(6)) % np.uint64(words)).astype(np.int64), np.uint64(1) << (at % np.uint64(64)))
    return out


def folded(bits: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    """The bitmap that the same shingles have in fewer words."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def needed(a, b):
    """The least overlap of two sets of these sizes that are similar enough."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def may_link(na, nb, bits_a, bits_b):
    """The bound that trees prune by, for pairs: shared tokens lie on shared bits, but for tokens that share a bit within their own set."""
    spare = np.minimum(na - popcount(bits_a), nb - popcount(bits_b))
    most = np.minimum(np.minimum(na, nb), popcount(bits_a & bits_b) + spare)
    return most >= needed(na, nb)


class SignatureTree:
    """Classes of one block, by size, in leaves of LEAF and inner nodes of FANOUT children."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, groups: np.ndarray):
        self.order = np.lexsort((groups, sizes))
        n, b, g = sizes[self.order], bits[self.order], groups[self.order]
        self.n, self.bits, self.groups = n, b, g
        spare = n - popcount(b)
        cuts = np.arange(0, len(n), LEAF)
        level = {
            "bits": np.bitwise_or.reduceat(b, cuts, axis=0), "low": np.minimum.reduceat(n, cuts), "high": np.maximum.reduceat(n, cuts),
            "spare": np.maximum.reduceat(spare, cuts), "first": np.minimum.reduceat(g, cuts), "last": np.maximum.reduceat(g, cuts),
        }
        self.levels = [level]
        while len(level["low"]) > 1:
            cuts = np.arange(0, len(level["low"]), FANOUT)
            level = {k: f.reduceat(level[k], cuts, axis=0) for k, f in (("bits", np.bitwise_or), ("low", np.minimum), ("high", np.maximum), ("spare", np.maximum), ("first", np.minimum), ("last", np.maximum))}
            self.levels.append(level)

    def leaf(self, i: int) -> slice:
        return slice(i * LEAF, (i + 1) * LEAF)


def dual_traversal(a: SignatureTree, b: SignatureTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in a's and b's input) of pairs in different groups that the bounds cannot rule out. Pairs of nodes go down level
    by level; ``a is b`` joins a tree with itself, each pair once."""
    itself = a is b
    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, i, j = stack.pop()
        x, y = a.levels[la], b.levels[lb]
        most = popcount(x["bits"][i] & y["bits"][j]) + np.minimum(x["spare"][i], y["spare"][j])
        most = np.minimum(most, np.minimum(x["high"][i], y["high"][j]))
        low = np.maximum(x["low"][i], y["low"][j])
        reach = (most >= needed(x["low"][i], y["low"][j])) & (100 * np.minimum(x["high"][i], y["high"][j]) >= PERCENT * low)
        one_group = (x["first"][i] == x["last"][i]) & (y["first"][j] == y["last"][j]) & (x["first"][i] == y["first"][j])
        keep = reach & ~one_group
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            for p, q in zip(i.tolist(), j.tolist(), strict=True):
                s, t = a.leaf(p), b.leaf(q)
                na, nb = a.n[s][:, None], b.n[t][None, :]
                ok = (a.groups[s][:, None] != b.groups[t][None, :]) & (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb))
                if itself and p == q:
                    ok = np.triu(ok, 1)
                u, v = np.nonzero(ok)
                if len(u):
                    u, v = u + p * LEAF, v + q * LEAF
                    fit = may_link(a.n[u], b.n[v], a.bits[u], b.bits[v])
                    if fit.any():
                        yield a.order[u[fit]], b.order[v[fit]]
            continue
        down_a, down_b = la > 0 and (la >= lb or itself), lb > 0 and (lb >= la or itself)
        ci = (i[:, None] * FANOUT + np.arange(FANOUT)) if down_a else i[:, None]
        cj = (j[:, None] * FANOUT + np.arange(FANOUT)) if down_b else j[:, None]
        i2, j2 = np.repeat(ci, cj.shape[1], axis=1).ravel(), np.tile(cj, (1, ci.shape[1])).ravel()
        la2, lb2 = la - down_a, lb - down_b
        inside = (i2 < len(a.levels[la2]["low"])) & (j2 < len(b.levels[lb2]["low"]))
        if itself:
            inside &= i2 <= j2
        i2, j2 = i2[inside], j2[inside]
        for at in range(0, len(i2), 4096):  # bounded work in memory
            stack.append((la2, lb2, i2[at : at + 4096], j2[at : at + 4096]))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node that links reach. Each round hooks the neighbours
    of a node onto their smallest, first those above it, then those below; minima are combined before they are shuffled. Rounds end
    as soon as every node hangs on one that hangs on none, which one small aggregate tells."""
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    while not _settled(e):
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        up = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut_lineage(down)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _settled(e: DataFrame) -> bool:
    """Whether of the distinct edges (u, v) with u > v no node has two that lead down, or one that does and one that comes from above."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 AND down > 0").isEmpty()


def _among(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which of ``s`` are in ``common``, which is sorted: the work grows with ``s``, and with ``common`` only by its logarithm."""
    return common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s if len(common) else np.zeros(len(s), bool)


def _common(docs: DataFrame) -> np.ndarray:
    """Hashes of very common shingles, sorted; at most MOST_COMMON."""

    def each(batches):
        no_cache()
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                sets = sets_of(b.column(0).slice(at, ROWS), SHINGLE)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    few = docs.where(F.pmod(F.xxhash64("i"), F.lit(SAMPLED)) == 0).select("t").mapInArrow(each, "h long")
    counts = few.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_COUNT)
    top = counts.orderBy(F.desc("n"), "h").limit(MOST_COMMON).select("h").toPandas()
    return np.sort(top["h"].to_numpy(np.int64).view(np.uint64))


def _sets(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, set_key, bits, prefix): rows with equal sets have equal keys; the bitmap has the set's own width, and
    the prefix are the shingles that the set is entered under. The rest of a set is not kept."""

    def each(batches):
        no_cache()
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                rows = []
                for s in sets_of(b.column(1).slice(at, ROWS), SHINGLE):
                    last = _among(s, common)
                    first = np.concatenate([s[~last], s[last]])[: prefix_size(len(s)) if len(s) else 0]
                    rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), bitmap(s).tobytes(), first.tobytes()))
                n, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, ROWS), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in rest]], ["doc_id", "n_shingles", "set_key", "bits", "prefix"])

    return docs.mapInArrow(each, "doc_id long, n_shingles long, set_key binary, bits binary, prefix binary")


def _classes(able: DataFrame, column: str) -> DataFrame:
    """(id, n_shingles, column) of every class, under the smallest id of its documents."""
    first = [F.first(c).alias(c) for c in ("n_shingles", column)]
    return able.groupBy("set_key").agg(F.min("doc_id").alias("id"), *first).drop("set_key")


def _entries(classes: DataFrame, common: np.ndarray) -> DataFrame:
    """(key, salt, id, n): one row for each shingle of a class's prefix. Common ones are dealt over SALTS parts."""

    def each(batches):
        for b in batches:
            i, n = (b.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            data, at = column_bytes(b.column(2))
            keys, at = data.view(np.uint64), at // 8
            begin = 0
            while begin < len(i):  # some classes at a time
                end = max(begin + 1, int(np.searchsorted(at, at[begin] + ENTRIES, side="right")) - 1)
                some, counts = keys[at[begin] : at[end]], np.diff(at[begin : end + 1])
                own = np.repeat(i[begin:end], counts)
                part = (own.view(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(SALTS)
                salt = np.where(_among(some, common), 1 + part.astype(np.int8), 0)
                yield _batch(schema, some.view(np.int64), salt, own, np.repeat(n[begin:end], counts))
                begin = end

    schema = "key long, salt byte, id long, n int"
    return classes.select("id", "n_shingles", "prefix").mapInArrow(each, schema)


def _rooted(entries: DataFrame) -> DataFrame:
    """(key, salt, id, n, root, root_n): every entry but the first of a block with the block's first class, its root. Sorted rows
    are read once, with one row kept. A salted part's root is given out too, as its own root: the parts' roots meet later."""
    ordered = entries.repartition("key", "salt").sortWithinPartitions("key", "salt", "id")
    schema = "key long, salt byte, id long, n int, root long, root_n int"

    def each(batches):
        last = None  # the last block begun: key, salt, root, its size, whether it has been given out
        for b in batches:
            if not b.num_rows:
                continue
            key, salt, i, n = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
            if last and last[0] == key[0] and last[1] == salt[0]:
                new[0] = False
            starts = np.flatnonzero(new)
            block = np.cumsum(new) - 1  # -1: goes on with the block before
            roots = np.concatenate([[last[2] if last else 0], i[starts]])
            root_n = np.concatenate([[last[3] if last else 0], n[starts]])
            member = ~new
            yield _batch(schema, key[member], salt[member], i[member], n[member], roots[block[member] + 1], root_n[block[member] + 1])
            hot = new & (salt > 0)  # roots of salted parts meet again below
            if hot.any():
                yield _batch(schema, key[hot], salt[hot], i[hot], n[hot], i[hot], n[hot])
            last = (key[-1], salt[-1], roots[block[-1] + 1], root_n[block[-1] + 1])

    return ordered.mapInArrow(each, schema)


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "byte": pa.int8()}
    names = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], [x for x, _ in names])


def _similar_size(a: str, b: str):
    return 100 * F.least(a, b).cast("long") >= PERCENT * F.greatest(a, b).cast("long")


class _Bitmaps:
    """Bitmaps of several widths; wider ones are folded to be compared with narrower ones."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        rows = [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
        self.width = np.array([len(x) for x in rows], np.int64)
        self.tables: dict[int, np.ndarray] = {}
        self.place: dict[int, np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width >= w)
            self.tables[w] = np.stack([folded(rows[k], w) for k in at.tolist()])
            self.place[w] = np.full(len(rows), -1, np.int64)
            self.place[w][at] = np.arange(len(at))

    def may_link(self, p: np.ndarray, q: np.ndarray, sizes: np.ndarray, other: _Bitmaps | None = None, other_sizes: np.ndarray | None = None) -> np.ndarray:
        """For pairs of rows (``q`` of ``other``, if given), whether the bound of the narrower width lets them through."""
        o, n = other or self, sizes if other_sizes is None else other_sizes
        width, ok = np.minimum(self.width[p], o.width[q]), np.zeros(len(p), bool)
        for w in np.unique(width).tolist():
            of = np.flatnonzero(width == w)
            table = [x.tables[w] if w in x.tables else None for x in (self, o)]
            ok[of] = may_link(sizes[p[of]], n[q[of]], table[0][self.place[w][p[of]]], table[1][o.place[w][q[of]]])
        return ok


def _fitting(na: pa.Array, nb: pa.Array, bits_a: pa.Array, bits_b: pa.Array) -> pa.Array:
    if not len(na):
        return pa.array([], pa.bool_())
    both = _Bitmaps(pa.chunked_array([bits_a, bits_b]))
    sizes = np.concatenate([na.to_numpy(), nb.to_numpy()])
    at = np.arange(len(na))
    return pa.array(both.may_link(at, at + len(na), sizes))


def _bounded(pairs: DataFrame, able: DataFrame) -> DataFrame:
    """Pairs (a, b) that their bitmaps do not rule out."""
    classes = _classes(able, "bits")
    left = classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("bits_a"))
    right = classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("bits_b"))
    fit = F.arrow_udf(_fitting, "boolean")
    return pairs.join(left, "a").join(right, "b").where(fit("na", "nb", "bits_a", "bits_b")).select("a", "b")


def _positions(i: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    h = mix(i.astype(np.int64).view(np.uint64))
    for k in (np.uint64(0), np.uint64(32)):
        part = h >> k
        yield ((part >> np.uint64(6)) % np.uint64(FILTER_WORDS)).astype(np.int64), np.uint64(1) << (part % np.uint64(64))


def _id_filter(pairs: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids in pairs: FILTER_WORDS words whatever their number."""

    def each(batches):
        for b in batches:
            i = np.unique(np.concatenate([c.to_numpy(zero_copy_only=False) for c in b.columns]))
            for at, bit in _positions(i):
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit.view(np.int64))], ["at", "bit"])

    words = pairs.select("a", "b").mapInArrow(each, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(FILTER_WORDS, np.uint64)
    out[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _passes(wanted: np.ndarray, i: np.ndarray) -> np.ndarray:
    ok = np.ones(len(i), bool)
    for at, bit in _positions(i):
        ok &= (wanted[at] & bit) != 0
    return ok


def _whole_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(i, s): the whole sets of the documents whose ids are in the columns a and b, and of a few others. Texts are not moved: a
    filter of fixed size tells which of them to make sets of."""
    wanted = _id_filter(ids)

    def each(batches):
        no_cache()
        for b in batches:
            i = b.column(0).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(_passes(wanted, i))
            for k in range(0, len(at), ROWS):
                some = at[k : k + ROWS]
                sets = [s.tobytes() for s in sets_of(b.column(1).take(pa.array(some)), SHINGLE)]
                yield pa.RecordBatch.from_arrays([pa.array(i[some], pa.int64()), pa.array(sets, pa.binary())], ["i", "s"])

    return stored(docs.where("i IS NOT NULL").mapInArrow(each, "i long, s binary"), "pair-sets")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    pairs = cut_lineage(pairs)
    if pairs.isEmpty():
        return pairs
    sets = _whole_sets(pairs, docs)
    linked = F.arrow_udf(confirmed, "boolean")
    found = pairs.join(sets.select(F.col("i").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("i").alias("b"), F.col("s").alias("sb")), "b")
    return found.where(linked("sa", "sb")).select("a", "b").distinct()


def _tree_members(members: DataFrame, able: DataFrame, known: DataFrame) -> DataFrame:
    """(key, id) of the classes of a block that are in a pair of different known groups which dual traversal of the block's trees leaves
    over, and of which no earlier block holds both. Most members are in no such pair: what a class's blocks are is only looked up for the
    others, and those are gone through once more."""
    classes = _classes(able, "bits")
    near = stored(_looked_through(members, classes, known, False), "near-members")
    return near if near.isEmpty() else _looked_through(near, classes, known, True)


def _looked_through(members: DataFrame, classes: DataFrame, known: DataFrame, first_only: bool) -> DataFrame:
    """(key, id) of members of pairs that the trees leave over; with ``first_only``, of pairs that no earlier block of ``members`` holds."""
    grouped = members.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_blocks = grouped.groupBy("key").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    parts = open_blocks.select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts"))
    rows = grouped.join(parts, "key").join(classes.select("id", "n_shingles", "bits"), "id")
    if first_only:
        rows = rows.join(members.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys")), "id")  # of the class's prefix at most
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # a block larger than one tree: every pair of its parts is one task's work
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("other", other).withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})

    def join(batches):
        """Blocks of the sorted rows; the last one of a batch may go on in the next."""
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b] if rest is None else [rest, b]).combine_chunks()
            key, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
            if not len(key):
                continue
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            whole, rest = t.slice(0, new[-1]), t.slice(new[-1]).combine_chunks().to_batches()[0]
            yield from _block_members(whole.combine_chunks(), new)
        if rest is not None:
            yield from _block_members(pa.Table.from_batches([rest]), np.array([0, rest.num_rows]))

    ordered = rows.select("key", "i", "j", "part", "id", F.col("component").alias("group"), "n_shingles", "bits", *["keys"] * first_only).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(join, "key long, id long").distinct()


def _block_members(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, id) of the members of the pairs that the blocks in ``t`` leave over; blocks begin at ``starts`` (the last of these is the end)."""
    if not t.num_rows:
        return
    key, ids, sizes, groups, part, i, j = (t.column(c).to_numpy() for c in ("key", "id", "n_shingles", "group", "part", "i", "j"))
    own = _Bitmaps(t.column("bits"))
    bits = own.tables[BITMAP_WORDS] if BITMAP_WORDS in own.tables else np.stack([folded(x, BITMAP_WORDS) for x in own.tables[int(own.width.min())]])
    first_only = "keys" in t.column_names
    if first_only:
        lists = t.column("keys").combine_chunks()
        first_key, all_keys = lists.offsets.to_numpy(), lists.values.to_numpy()
    near = np.zeros(t.num_rows, bool)

    def look(p: np.ndarray, q: np.ndarray) -> None:
        for at in range(0, len(p), PAIRS):
            x, y = p[at : at + PAIRS], q[at : at + PAIRS]
            new = ~(near[x] & near[y])
            x, y = x[new], y[new]
            if len(x):
                fit = own.may_link(x, y, sizes)
                x, y = x[fit], y[fit]
            if len(x) and first_only:
                fit = ~_shared_before(key[x], first_key, all_keys, x, y)
                x, y = x[fit], y[fit]
            near[x] = near[y] = True

    counts = np.diff(starts)
    for m in np.unique(counts).tolist():
        of = starts[:-1][counts == m]
        if m <= LEAF:  # trees of one leaf: all of a size together
            x, y = np.triu_indices(m, 1)
            for at in range(0, len(of), max(1, 200_000 // max(1, len(x)))):
                some = of[at : at + max(1, 200_000 // max(1, len(x)))]
                p, q = (some[:, None] + x).ravel(), (some[:, None] + y).ravel()
                ok = (groups[p] != groups[q]) & ((i[p] == j[p]) | (part[p] != part[q])) & (100 * np.minimum(sizes[p], sizes[q]) >= PERCENT * np.maximum(sizes[p], sizes[q]))
                look(p[ok], q[ok])
            continue
        for start in of.tolist():
            at = np.arange(start, start + m)
            left, right = at[part[at] == i[start]], at[part[at] == j[start]]
            if len(left) and len(right):
                one = SignatureTree(sizes[left], bits[left], groups[left])
                two = one if i[start] == j[start] else SignatureTree(sizes[right], bits[right], groups[right])
                u, v, held = [], [], 0
                for x, y in dual_traversal(one, two):
                    u.append(left[x])
                    v.append(right[y])
                    held += len(x)
                    if held > 4 * PAIRS:
                        look(np.concatenate(u), np.concatenate(v))
                        u, v, held = [], [], 0
                if u:
                    look(np.concatenate(u), np.concatenate(v))
    at = np.flatnonzero(near)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(ids[at])], ["key", "id"])


def _shared_before(key: np.ndarray, first: np.ndarray, keys: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For pairs of rows met in the block ``key``, whether both have a smaller key too. Row r's keys are keys[first[r]:first[r + 1]]."""

    def spread(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = first[rows + 1] - first[rows]
        pair = np.repeat(np.arange(len(rows)), n)
        at = np.repeat(first[rows], n) + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        smaller = keys[at] < key[pair]
        return pair[smaller], keys[at][smaller]

    (pair_p, key_p), (pair_q, key_q) = spread(p), spread(q)
    out = np.zeros(len(p), bool)
    if len(key_p) and len(key_q):
        names, codes = np.unique(np.concatenate([key_p, key_q]), return_inverse=True)
        here = pair_p * len(names) + codes[: len(key_p)]
        out[pair_p[np.isin(here, pair_q * len(names) + codes[len(key_p) :])]] = True
    return out


def _tree_links(members: DataFrame, able: DataFrame, known: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that join different known groups; all that trees leave over is compared on whole sets."""
    near = stored(_tree_members(members, able, known), "near")
    if near.isEmpty():
        return known.sparkSession.createDataFrame([], "a long, b long")
    sets = _whole_sets(near.select(F.col("id").alias("a"), F.col("id").alias("b")), docs)
    sizes = able.groupBy("doc_id").agg(F.max("n_shingles").alias("n")).withColumnRenamed("doc_id", "id")
    whole = near.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")).join(sizes, "id")
    dealt = in_parts(whole, 8 * F.col("n"), PART).select("key", "i", "j", "part", "id", "component")
    met = dealt.join(sets.select(F.col("i").alias("id"), "s"), "id").select("key", "i", "j", "part", "id", "component", "s")
    sorted_rows = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sorted_rows.mapInArrow(by_block(joining_links, "a long, b long"), "a long, b long").distinct()


def join_groups(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: its set's size, and the smallest id that links reach.

    Null and empty texts have no shingles and link with nothing. A row without an id keeps a null component and links with nothing.
    Repeated rows stay; rows of one id are one document, whatever their texts. Other columns play no part.
    """
    docs = df.select(F.col(id).cast("long").alias("i"), F.col(text).alias("t"))
    common = _common(docs)
    sets = stored(_sets(docs, common), "shingle-sets")
    able = sets.where("doc_id IS NOT NULL AND n_shingles > 0")

    rooted = stored(_rooted(_entries(_classes(able, "prefix"), common)), "blocks")
    hot = rooted.where("salt > 0 AND id = root")
    tops = hot.groupBy("key").agg(F.min(F.struct("root", "root_n")).alias("top"))
    roots = hot.join(tops, "key").select("id", "n", F.col("top.root").alias("root"), F.col("top.root_n").alias("root_n"))
    tries = rooted.select("id", "n", "root", "root_n").unionByName(roots).where(_similar_size("n", "root_n") & (F.col("id") != F.col("root")))
    pairs = tries.select(F.greatest("id", "root").alias("a"), F.least("id", "root").alias("b")).distinct()
    known = components(_verified(_bounded(pairs, able), docs))

    # blocks of three classes or more: of two, the tries hold the only pair. An unsalted block's root has no row of its own.
    wide = rooted.groupBy("key").agg(F.count("*").alias("m"), F.max("salt").alias("s")).where("m > IF(s > 0, 2, 1)").select("key")
    in_wide = rooted.join(wide, "key")
    members = stored(in_wide.select("key", "id").unionByName(in_wide.select("key", F.col("root").alias("id"))).distinct(), "members")
    more = _tree_links(members, able, known, docs)
    known = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    named = able.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    placed = named.join(known, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    # a set's rows may be a third of all: a plain join, whose skewed parts Spark splits
    joined = sets.select("doc_id", "n_shingles", "set_key").join(placed, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with one document of each group: that of the smallest id, once if its row is repeated.

    Rows without words or without an id are in no group and stay. Most documents are alone in their group; a filter of fixed size
    tells rows that surely are, which then stay where they are, and only the others meet the groups in a join.
    """
    groups = join_groups(df, id, text).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("first"))
    special = stored(groups.where("n > 1 OR first <> doc_id"), "grouped")
    wanted = _id_filter(special.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")))

    def passes(i: pa.Array) -> pa.Array:
        return pa.array(_passes(wanted, i.fill_null(0).to_numpy(zero_copy_only=False)) & i.is_valid().to_numpy(zero_copy_only=False), pa.bool_())

    maybe = F.arrow_udf(passes, "boolean")(F.col(id).cast("long"))
    asked = df.where(maybe)
    copies = special.select(F.col("doc_id").alias("_id"), F.col("first").alias("_first"))
    met = asked.join(copies, F.col(id).cast("long") == F.col("_id"), "left")
    alone = met.where("_id IS NULL").select(*df.columns)
    firsts = met.where("_id = _first").select(*df.columns).dropDuplicates([id])
    return df.where(~maybe).unionByName(alone).unionByName(firsts)
