"""Periodic runs of words in documents, and texts with their repetitions collapsed.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word extends.
Two occurrences i < j of the same l words make a *maximal pair* if the words before them differ and the words behind them differ;
a maximal pair with l >= (times - 1) * (j - i) is exactly the run that starts at i, has period j - i and l + j - i words: nothing
is extended afterwards. Pairs are read off the LCP-interval tree of the words' suffixes, bottom-up: a node of depth l holds the
positions of its suffixes in order, each with the class of its left word. When children meet in a node, the pairs that become
neighbours have exactly l words in common; those of different left classes are maximal, and those near enough are runs. (Between
the two positions of a run of smallest period lies no other position of the node: it would give a smaller period.)

Suffixes are sorted by prefix doubling, many documents at once, each closed by a word of its own. Only positions whose first words
occur again in the document stay in the sort: other suffixes are leaves too high in the tree to hold a run.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 6, 4  # words of a run, and periods that it holds, at least
TOGETHER = 200_000  # words of the documents that are sorted at once

RUNS_TYPE = "struct<n_words long, runs array<struct<start long, length long, period long>>, collapsed string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_overlap(least: int = LEAST, times: int = TIMES) -> int:
    """The fewest words that both positions of a run have in common, whatever its period."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def sorted_repeats(s: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``s`` that have ``depth`` words or more in common with another, in suffix order, and the words each has in common
    with the one before it. The last word of ``s`` occurs once. Words are numbers from 0 up; suffixes are ordered by any fixed order
    of words."""
    n = len(s)
    counts = np.bincount(s)
    rank = (np.cumsum(counts) - counts)[s].astype(np.int32)  # of a group: the place of its first suffix
    levels, at, h, kept = [rank], np.flatnonzero(counts[s] > 1), 1, None
    if depth <= 1:
        kept = at
    while len(at):
        key = rank[at].astype(np.int64) * n + rank[at + h]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        old = rank[at]
        index = np.arange(len(at))
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first_old, first = np.maximum.accumulate(np.where(new_old, index, 0)), np.maximum.accumulate(np.where(new, index, 0))
        rank = rank.copy()
        rank[at] = old + (first - first_old)
        levels.append(rank)
        alone = new & np.concatenate([new[1:], [True]])
        at, h = at[~alone], 2 * h
        if kept is None and 2 * h > depth:  # the largest prefix known by now that is not longer than depth
            kept = at
    if kept is None or not len(kept):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kept = kept[np.argsort(rank[kept], kind="stable")]
    a, b = kept[:-1], kept[1:]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a + common, n - 1)] == levels[k][np.minimum(b + common, n - 1)]
        common += same.astype(np.int64) << k
    return kept, np.concatenate([[0], common])


def maximal_pairs(positions: list[int], common: list[int], left: list[int], least: int, times: int, depth: int) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period of the runs that the tree over these suffixes holds. ``common`` is what each suffix has in
    common with the one before; ``left[i]`` is the class of the word before position i."""
    runs: dict[tuple[int, int], int] = {}

    def found(i: int, j: int, words: int) -> None:
        q = j - i
        if (times - 1) * q <= words and words + q >= least and left[i] != left[j]:
            end = j + words
            if q < runs.get((i, end), q + 1):
                runs[i, end] = q

    def merged(a: list[int], b: list[int], words: int) -> list[int]:
        """The node's list of positions out of two children's; their new neighbours are looked at."""
        if len(a) < len(b):
            a, b = b, a
        places = [bisect_left(a, x) for x in b]
        last = len(a)
        for x, k in zip(b, places):
            if k:
                found(a[k - 1], x, words)
            if k < last:
                found(x, a[k], words)
        if len(b) == 1:
            a.insert(places[0], b[0])
        else:
            a.extend(b)
            a.sort()
        return a

    open_nodes: list[tuple[int, list[int]]] = []
    child: list[int] = []
    for p, words in zip(positions, common):
        if child:
            while open_nodes and open_nodes[-1][0] > words:
                above, held = open_nodes.pop()
                child = merged(held, child, above)
            if words < depth:
                open_nodes.clear()
            elif open_nodes and open_nodes[-1][0] == words:
                open_nodes[-1] = words, merged(open_nodes[-1][1], child, words)
            else:
                open_nodes.append((words, child))
        child = [p]
    while open_nodes:
        above, held = open_nodes.pop()
        child = merged(held, child, above)
    return runs


def runs_of(docs: list[list], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of every document, a list of words, by start, then period."""
    numbers: list[int] = []
    starts = []
    for words in docs:
        starts.append(len(numbers))
        known: dict = {}
        base = numbers[-1] + 1 if numbers else 0  # documents share no number, so no suffix of one is near one of another
        numbers += [base + known.setdefault(w, len(known)) for w in words]
        numbers.append(base + len(known))
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not numbers:
        return out
    s = np.array(numbers, np.int64)
    depth = least_overlap(least, times)
    at, common = sorted_repeats(s, depth)
    left = [-1, *numbers[:-1]]
    found = sorted((i, q, end) for (i, end), q in maximal_pairs(at.tolist(), common.tolist(), left, least, times, depth).items())
    of = np.searchsorted(starts, [i for i, _, _ in found], side="right") - 1
    for (i, q, end), k in zip(found, of.tolist(), strict=True):
        out[k].append((i - starts[k], end - i, q))
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _in_groups(rows: list[list], size: int):
    """Consecutive rows with about ``size`` words together; a longer one is alone."""
    group, words = [], 0
    for r in rows:
        if group and words + len(r) > size:
            yield group
            group, words = [], 0
        group.append(r)
        words += len(r) + 1
    if group:
        yield group


def _measured(least: int, times: int):
    def each(texts: pa.Array) -> pa.Array:
        docs = [x.as_py().split() if x.is_valid else [] for x in texts.cast(pa.binary())]  # of bytes: splits at ASCII white space only
        n, offsets, flat, kept = [], [0], [], []
        for group in _in_groups(docs, TOGETHER):
            for words, runs in zip(group, runs_of(group, least, times), strict=True):
                n.append(len(words))
                flat += runs
                offsets.append(len(flat))
                kept.append(b" ".join(collapsed(words, runs)))
        columns = list(zip(*flat, strict=True)) if flat else [(), (), ()]
        runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_RUN))
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), listed, pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])

    return each


def with_runs(df: DataFrame, text: str = "text", name: str = "runs", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """All rows with the struct ``name``: n_words, the runs (start, length, period) of at least ``least`` words and ``times`` periods by
    start, then period, and the text ``collapsed``: every run cut to its first period, words joined by one space.

    Words are stretches of anything but ASCII white space; case counts. Null, empty and blank texts have no words, no runs and an empty
    collapsed text. A text of any length is looked at whole; it takes about 100 bytes a word in its task. Rows stay where they
    are: nothing is shuffled, repeated rows stay repeated, no row is lost. A column called ``name`` is replaced, others are kept.
    """
    if times < 2:
        raise ValueError("a run holds its period twice at least")
    measured = F.arrow_udf(_measured(least, times), RUNS_TYPE).asNondeterministic()  # so that it runs once, however often it is read
    return df.withColumn(name, measured(F.col(text)))


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; of equal ones the first. Null if there is none."""
    none = F.lit(None).cast("struct<start long, length long, period long>")
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def listed(runs: Column) -> Column:
    """One line start,length,period for each run."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return F.array_join(lines, "")


def looped(id: Column, text: Column) -> Column:
    """The text's words joined by one space; for one id in ten, by its checksum, the words from some place on are made periodic. Null
    ids stay as they are, null texts are empty."""
    import zlib

    def each(ids: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for i, t in zip(ids.to_pylist(), texts.cast(pa.binary()), strict=True):
            words = t.as_py().split() if t.is_valid else []
            n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
            if h % 10 == 0 and n:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                period = words[a : a + p]
                words = words[:a] + (period * (-(-(n - a) // p)))[: n - a]
            out.append(b" ".join(words))
        return pa.array(out, pa.binary()).cast(pa.string())

    return F.arrow_udf(each, "string")(id.cast("long"), text)
