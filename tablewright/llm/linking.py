"""What the near-duplicate operators share: sets of shingles, and exact comparison of whole sets in blocks of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.bytewords import WORD_BYTES, column_bytes, mix, word_hashes

PERCENT = 80  # 100 * intersection >= PERCENT * union
TOGETHER = 2 << 20  # bytes of text whose words are hashed at once

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def sets_of(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's shingles of ``size`` words. A text of fewer words has one, of its whole sequence;
    without words, none."""
    data, at = column_bytes(texts)
    out: list[np.ndarray] = []
    begin, n = 0, len(texts)
    while begin < n:  # some texts at a time
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + TOGETHER, side="right")) - 1)
        h, counts = word_hashes(data[at[begin] : at[end]], at[begin : end + 1] - at[begin], WORD_BYTES)
        ends = np.cumsum(counts)
        whole = max(0, len(h) - size + 1)
        full = np.full(whole, size, np.uint64)
        for k in range(size):
            full = mix(full + h[k : k + whole] * _MULTIPLIERS[k])
        for c, e in zip(counts.tolist(), ends.tolist()):
            if c >= size:
                s = np.sort(full[e - c : e - size + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif c:
                x = np.array([c], np.uint64)
                for k in range(c):
                    x = mix(x + h[e - c + k : e - c + k + 1] * _MULTIPLIERS[k])
                out.append(x)
            else:
                out.append(np.empty(0, np.uint64))
        begin = end
    return out


def linked(both, na, nb):
    """Whether sets of these sizes and overlap are similar enough."""
    return (both > 0) & (100 * both >= PERCENT * (na + nb - both))


def confirmed(a: pa.Array, b: pa.Array) -> pa.Array:
    """For pairs of whole sets, whether they are similar enough."""
    out = []
    for x, y in zip(a, b, strict=True):
        s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        if len(s) > len(t):
            s, t = t, s
        both = int(np.count_nonzero(t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s)) if len(s) else 0
        out.append(bool(linked(both, len(s), len(t))))
    return pa.array(out, pa.bool_())


def by_block(work: Callable[[pa.Table], tuple | None], schema: str):
    """A function of the rows of one (key, i, j) each, for rows that come sorted by them."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # the block that may go on in the next batch
        last = None

        def out(rows: pa.Table):
            found = work(rows)
            if found is not None and len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

        for b in batches:
            if not b.num_rows:
                continue
            key, i, j = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            cuts = [0, *new.tolist(), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:]):
                at = (key[x], i[x], j[x])
                if rest and at != last:
                    yield from out(pa.Table.from_batches(rest).combine_chunks())
                    rest = []
                rest.append(b.slice(x, y - x))
                last = at
        if rest:
            yield from out(pa.Table.from_batches(rest).combine_chunks())

    return run


def joining_links(t: pa.Table) -> tuple | None:
    """(a, b): links between rows of different groups by their whole sets, as many as join the groups that links reach, no more."""
    ids, group, part = t.column("id").to_numpy(), t.column("component").to_numpy().copy(), t.column("part").to_numpy()
    if (group == group[0]).all():
        return None
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("s")]
    n = np.array([len(s) for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    names, counts = np.unique(group, return_counts=True)
    mark = np.zeros(int(codes.max()) + 1, np.int64)
    a, b = [], []
    # of two groups one at least is not the largest: its members look at all others
    for at in np.flatnonzero(group != names[counts.argmax()]).tolist():
        ok = (group != group[at]) & (100 * np.minimum(n, n[at]) >= PERCENT * np.maximum(n, n[at]))
        if i != j:
            ok &= part != part[at]
        if not ok.any():
            continue
        own = codes[starts[at] : starts[at] + n[at]]
        mark[own] = 1
        both = np.add.reduceat(mark[codes], starts)
        mark[own] = 0
        for k in np.flatnonzero(ok & linked(both, n, n[at])).tolist():
            if group[k] != group[at]:
                a.append(max(ids[k], ids[at]))
                b.append(min(ids[k], ids[at]))
                group[group == group[k]] = group[at]
    return a, b


def parts_of(size: Column, most: int) -> Column:
    """Into how many parts a block is cut: one for every ``most`` bytes of its rows. An aggregate."""
    return F.greatest(F.ceil(F.sum(size) / most), F.lit(1)).cast("int")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows (key, id, parts, ...) with i, j, part: every pair of a block's parts is one task's work."""
    cut = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return cut.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})


def in_parts(rows: DataFrame, size: Column, most: int) -> DataFrame:
    """Rows (key, id, ...) with i, j, part: a block whose rows have over ``most`` bytes is cut into parts."""
    return dealt(rows.join(rows.groupBy("key").agg(parts_of(size, most).alias("parts")), "key"))
