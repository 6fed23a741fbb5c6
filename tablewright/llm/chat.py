"""Chat formatting with roles repaired at the least cost.

A conversation is legal if an automaton accepts its roles: an optional system turn, then user and assistant in turn, the
assistant last. A turn may keep its role, take another (relabel), join the turn before it (merge), and empty turns may be put in
front (insert); each has a price. What a turn does to the automaton is a matrix of least costs from state to state, so a stretch
of turns is a (min, +) product of matrices. Long conversations are cut in chunks: products of chunks are made in parallel, the states
at the cuts are chosen from those, and then every chunk is repaired and rendered by itself, with one row out for every row in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # a state is the role of the last turn
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
UNKNOWN = 0  # kind of a role that is none of the three; the others have their state's number
#: Other names of the roles.
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT}
CHUNK = 4096  # turn numbers of one chunk
NEVER = 1 << 40


@dataclass(frozen=True)
class Prices:
    relabel: int = 4
    relabel_unknown: int = 1
    merge: int = 1
    insert: int = 3


class Automaton:
    """Least costs of one turn of each kind, from state to state, and how."""

    def __init__(self, prices: Prices = Prices()):
        self.prices = prices
        self.inserts: dict[tuple[int, int], tuple[int, ...]] = {}  # (state, role) -> empty turns before a turn of that role may follow
        for state in FOLLOWS:
            paths = {s: () for s in (state,)}
            frontier = [state]
            while frontier:
                nearer = []
                for s in frontier:
                    for r in FOLLOWS[s]:
                        self.inserts.setdefault((state, r), paths[s])
                        if r not in paths:
                            paths[r] = (*paths[s], r)
                            nearer.append(r)
                frontier = nearer
        self.step = [[[self._cost(kind, p, q) for q in range(4)] for p in range(4)] for kind in range(4)]
        self.end = [self._end(s) for s in range(4)]

    def merges(self, p: int, q: int) -> bool:
        inserted = self.inserts.get((p, q))
        return p == q and (inserted is None or self.prices.merge <= len(inserted) * self.prices.insert)

    def _cost(self, kind: int, p: int, q: int) -> int:
        if q == START:
            return NEVER
        named = 0 if kind == q else self.prices.relabel_unknown if kind == UNKNOWN else self.prices.relabel
        if self.merges(p, q):
            return named + self.prices.merge
        inserted = self.inserts.get((p, q))
        return NEVER if inserted is None else named + len(inserted) * self.prices.insert

    def _end(self, state: int) -> int:
        """What it costs to finish: nothing after the assistant, else empty turns up to it."""
        return 0 if state == ASSISTANT else (len(self.inserts[state, ASSISTANT]) + 1) * self.prices.insert

    def forward(self, d: list[int], kind: int) -> list[int]:
        m = self.step[kind]
        return [min(d[p] + m[p][q] for p in range(4)) for q in range(4)]

    def backward(self, d: list[int], kind: int, q: int) -> int:
        """The first state before a turn that leads to ``q`` at the least cost."""
        m = self.step[kind]
        return min(range(4), key=lambda p: (d[p] + m[p][q], p))

    def finish(self, d: list[int]) -> int:
        return min(range(4), key=lambda s: (d[s] + self.end[s], s))

    def path(self, first: int, kinds: list[int], last: int) -> list[tuple[int, int]]:
        """(state before, role given) of every turn, from the state ``first`` to the state ``last``."""
        costs = [[0 if s == first else NEVER for s in range(4)]]
        for k in kinds:
            costs.append(self.forward(costs[-1], k))
        out, q = [], last
        for i in range(len(kinds) - 1, -1, -1):
            p = self.backward(costs[i], kinds[i], q)
            out.append((p, q))
            q = p
        out.reverse()
        return out


BEGIN, END, JOINT = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"


def piece(a: Automaton, p: int, q: int, text: str | None, last: bool) -> str:
    """What a turn adds to the rendered conversation: it closes the turn before (or joins it) and opens its own; the last one also
    closes and adds the empty turns at the end. All pieces in order are the conversation."""
    if a.merges(p, q):
        out = [JOINT, text or ""]
    else:
        out = [END if p != START else ""]
        out += [BEGIN.format(ROLES[r - 1]) + END for r in a.inserts[p, q]]
        out += [BEGIN.format(ROLES[q - 1]), text or ""]
    if last:
        out.append(END)
        if q != ASSISTANT:
            out += [BEGIN.format(ROLES[r - 1]) + END for r in (*a.inserts[q, ASSISTANT], ASSISTANT)]
    return "".join(out)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with equal first columns, together; the rows come sorted by them."""
    key, held = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


def _out(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def repaired(df: DataFrame, prices: Prices = Prices(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for every row: conv_id, turn, role, new_role, action (keep, relabel, merge, relabel+merge), inserted (roles of the empty
    turns put in front, comma-joined), at_end (those put behind the last turn), cost, piece.

    Turns are ordered by number, then role, then a hash of their text; null numbers come last. A null text is empty, a null or unknown
    role may become any. Rows without a conversation id form one conversation. Repeated rows are turns of their own. Of equally cheap
    repairs the same one is taken whatever the partitioning. Other columns play no part.
    """
    known = F.create_map(*[x for k, v in ALIASES.items() for x in (F.lit(k), F.lit(v))])
    kind = F.coalesce(known[F.lower(F.trim(F.col(role)))], F.lit(UNKNOWN))
    number = F.col(turn).cast("long")
    rows = df.select(
        F.col(conv).cast("long").alias("c"), F.coalesce(F.floor(number / CHUNK), F.lit(1 << 60)).cast("long").alias("chunk"), number.alias("t"),
        F.col(role).alias("r"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), kind.alias("k"), F.col(text).alias("x"),
    )
    last_number = F.coalesce("t", F.lit((1 << 63) - 1))
    order = [last_number, F.col("r").asc_nulls_first(), "h"]

    def products(batches):
        a = Automaton(prices)

        def each():
            for (c, chunk), turns in _runs(batches, 2):
                m = [[0 if p == q else NEVER for q in range(4)] for p in range(4)]
                for (k,) in turns:
                    m = [a.forward(row, k) for row in m]
                yield c, chunk, [min(x, NEVER) for row in m for x in row]

        yield from _out(each(), pa.schema([("c", pa.int64()), ("chunk", pa.int64()), ("m", pa.list_(pa.int64()))]))

    narrow = rows.repartition("c", "chunk").sortWithinPartitions("c", "chunk", *order).select("c", "chunk", "k")
    chunks = narrow.mapInArrow(products, "c long, chunk long, m array<long>")

    def cuts(batches):
        a = Automaton(prices)

        def each():
            for (c,), parts in _runs(batches, 1):
                d, entries = [0, NEVER, NEVER, NEVER], []
                for _, m in parts:
                    entries.append(d)
                    d = [min(min(d[p] + m[4 * p + q] for p in range(4)), NEVER) for q in range(4)]
                q = a.finish(d)
                ends = []
                for (_, m), e in zip(reversed(parts), reversed(entries), strict=True):
                    p = min(range(4), key=lambda p, e=e, m=m, q=q: (e[p] + m[4 * p + q], p))
                    ends.append((p, q))
                    q = p
                for k, ((chunk, _), (p, q)) in enumerate(zip(parts, reversed(ends), strict=True)):
                    yield c, chunk, p, q, k == len(parts) - 1

        yield from _out(each(), pa.schema([("c", pa.int64()), ("chunk", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("final", pa.bool_())]))

    bounds = chunks.repartition("c").sortWithinPartitions("c", "chunk").mapInArrow(cuts, "c long, chunk long, entry int, exit int, final boolean")
    bounds = bounds.select(F.col("c").alias("bc"), F.col("chunk").alias("bchunk"), "entry", "exit", "final")
    joined = rows.join(bounds, F.col("c").eqNullSafe(F.col("bc")) & (F.col("chunk") == F.col("bchunk")))
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("new_role", pa.string()), ("action", pa.string()), ("inserted", pa.string()), ("at_end", pa.string()), ("cost", pa.int64()), ("piece", pa.string())])

    def render(batches):
        a = Automaton(prices)

        def names(states):
            return ",".join(ROLES[s - 1] for s in states)

        def each():
            for (c, _), turns in _runs(batches, 2):
                entry, last, final = turns[0][4:]
                path = a.path(entry, [t[2] for t in turns], last)
                for i, ((t, r, k, x, *_), (p, q)) in enumerate(zip(turns, path, strict=True)):
                    closes = final and i == len(turns) - 1
                    merge = a.merges(p, q)
                    action = "+".join([*["relabel"] * (k != q), *["merge"] * merge]) or "keep"
                    behind = (*a.inserts[q, ASSISTANT], ASSISTANT) if closes and q != ASSISTANT else ()
                    cost = a.step[k][p][q] + (a.end[q] if closes else 0)
                    yield c, t, r, ROLES[q - 1], action, "" if merge else names(a.inserts[p, q]), names(behind), cost, piece(a, p, q, x, closes)

        yield from _out(each(), schema)

    ordered = joined.repartition("c", "chunk").sortWithinPartitions("c", "chunk", *order).select("c", "chunk", "t", "r", "k", "x", "entry", "exit", "final")
    return ordered.mapInArrow(render, "conv_id long, turn long, role string, new_role string, action string, inserted string, at_end string, cost long, piece string")
