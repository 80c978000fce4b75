"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``. Edits make it so: Keep a row (0), Rerole it to the user
or assistant due there (2), Delete it (3; required for blank and repeated rows), Insert an empty row that is due (2); a
truncated row that stays adds 1. Of the cheapest ways, the one whose audit (the edits' initials D, I, K, R in order) is
least in ASCII is taken.

What has been written decides which row is due next, and four states say it: nothing yet, after a system row, after a user, after
an assistant. So a stretch of rows is a 4 x 4 table: the cheapest way from each state to each, and the order
of their audits. Audits that end with a row consumed are never prefixes of each other, so their order at a border settles the order of
the whole. ``meet`` reconstructs a way in linear space: forward vectors of four costs from the left and backward vectors from
the right meet in the middle, the cheapest crossing with the least audit is chosen, and both halves recurse.

The same division spreads a conversation over tasks. Rows are range-partitioned in order and cut into blocks of
bounded rows and bytes. Conversations inside one block are repaired where they stand. Of the others each block yields its table; tables
are combined FAN at a time until one is left, then the crossings go down the same tree with ``meet``, and each block
reconstructs its rows between its two states. Repeats of a row in other blocks are found by the first place of each
digest. No task sees more of a conversation than a block or FAN tables.

Defined cases: null turns come first; rows of one turn are ordered by role and text; null ids are one conversation; null roles and
texts are one space; equal rows repeat each other; an empty table has no conversations; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import spread, stored

#: A block's rows and bytes of text, and the tables combined at a time.
BLOCK_ROWS, BLOCK_BYTES, FAN = 2048, 4 << 20, 64
NEVER = 1 << 60

# The states, and what may be written in each.
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
INSERT, DELETE, REROLE, TRUNCATED = 2, 3, 2, 1
#: What is inserted behind the last row, and its cost, by state.
ENDING = {START: ("", 0), SYSTEM: ("II", 4), USER: ("I", 2), ASSISTANT: ("", 0)}

# A row's type: the class of its initial (s, u, a, other) times 3, plus 1 if truncated, plus 2 if it has to go.
PLAIN, CUT, GOES = range(3)
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Table:
    """Cheapest costs from each state to each, and for each first state the order of the audits by last state."""

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]


Vector = tuple[tuple[int, ...], tuple[int, ...]]


def _kept(initial: int, state: int) -> int | None:
    """The state after a kept row whose initial has this class."""
    if initial == 0:
        return SYSTEM if state == START else None
    return DUE[state][1] if initial < 3 and DUE[state][0] == ("", "user", "assistant")[initial] else None


def _ranks(keys: list) -> tuple[int, ...]:
    order = {k: i for i, k in enumerate(sorted(k for k in keys if k is not None))}
    return tuple(-1 if k is None else order[k] for k in keys)


@functools.cache
def row_edits(kind: int) -> tuple[Table, tuple[tuple[str, ...], ...]]:
    """Table of one row of a type, and the edits it stands for: inserts in front of it, then its own."""
    initial, fault = divmod(kind, 3)
    costs, audits, ranks = [], [], []
    for first in range(4):
        best = [(NEVER, "")] * 4
        state, spent, inserted = first, 0, ""
        for _ in range(3):  # a fourth insert would come back to a state
            ways = [(DELETE, "D", state)]
            if fault != GOES:
                extra = TRUNCATED if fault == CUT else 0
                kept = _kept(initial, state)
                ways += [(extra, "K", kept)] if kept is not None else []
                ways.append((REROLE + extra, "R", DUE[state][1]))
            for cost, letter, last in ways:
                best[last] = min(best[last], (spent + cost, inserted + letter))
            spent, inserted, state = spent + INSERT, inserted + "I", DUE[state][1]
        costs.append(tuple(c for c, _ in best))
        audits.append(tuple(a for _, a in best))
        ranks.append(_ranks([a if c < NEVER else None for c, a in best]))
    return Table(tuple(costs), tuple(ranks)), tuple(audits)


def start(state: int) -> Vector:
    return tuple(0 if s == state else NEVER for s in range(4)), tuple(0 if s == state else -1 for s in range(4))


def forward(vector: Vector, table: Table) -> Vector:
    """Cheapest costs one stretch further, and the order of the audits that have them."""
    cost, rank = vector
    new, keys = [], []
    for last in range(4):
        ways = [(cost[s] + table.cost[s][last], rank[s], table.rank[s][last]) for s in range(4) if cost[s] < NEVER and table.cost[s][last] < NEVER]
        best = min(ways, default=None)
        new.append(NEVER if best is None else best[0])
        keys.append(None if best is None else best[1:])
    return tuple(new), _ranks(keys)


def backward(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    """Cheapest costs to the end, one stretch earlier."""
    return tuple(min(min(table.cost[s][t] + costs[t], NEVER) for t in range(4)) for s in range(4))


@functools.lru_cache(maxsize=1 << 16)
def _forward_row(vector: Vector, kind: int) -> tuple[Vector, int]:
    """forward() over a row, with the least cost taken out: such vectors are few."""
    cost, rank = forward(vector, row_edits(kind)[0])
    least = min(cost)
    return (tuple(c if c >= NEVER else c - least for c in cost), rank), least


@functools.lru_cache(maxsize=1 << 16)
def _backward_row(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    new = backward(costs, row_edits(kind)[0])
    least = min(new)
    return tuple(c if c >= NEVER else c - least for c in new)


def over(kinds: list[int], state: int) -> tuple[Vector, int]:
    """(vector, cost to add) behind a stretch of rows entered in a state."""
    vector, total = start(state), 0
    for kind in kinds:
        vector, least = _forward_row(vector, kind)
        total += least
    return vector, total


def table_of(kinds: list[int]) -> Table:
    """The table of a stretch of rows."""
    costs, ranks = [], []
    for state in range(4):
        (cost, rank), total = over(kinds, state)
        costs.append(tuple(c if c >= NEVER else c + total for c in cost))
        ranks.append(rank)
    return Table(tuple(costs), tuple(ranks))


def combined(tables: list[Table]) -> Table:
    """The table of neighbouring stretches."""
    costs, ranks = [], []
    for state in range(4):
        vector = start(state)
        for t in tables:
            vector = forward(vector, t)
        costs.append(vector[0])
        ranks.append(vector[1])
    return Table(tuple(costs), tuple(ranks))


def meet(steps: list, first: int, last: int) -> list[int]:
    """The states at the borders between steps (types of rows, or tables) on the way from first to last."""
    if len(steps) < 2:
        return []
    middle = len(steps) // 2
    rows = isinstance(steps[0], int)
    vector = start(first)
    for x in steps[:middle]:
        vector = _forward_row(vector, x)[0] if rows else forward(vector, x)
    rest = start(last)[0]
    for x in reversed(steps[middle:]):
        rest = _backward_row(rest, x) if rows else backward(rest, x)
    crossing = min((s for s in range(4) if vector[0][s] < NEVER and rest[s] < NEVER), key=lambda s: (vector[0][s] + rest[s], vector[1][s]))
    return [*meet(steps[:middle], first, crossing), crossing, *meet(steps[middle:], crossing, last)]


def ended(vector: Vector) -> tuple[int, int]:
    """(last state, cost) of the cheapest end with the least audit."""
    cost, rank = vector
    last = min((s for s in range(4) if cost[s] < NEVER), key=lambda s: (cost[s] + ENDING[s][1], rank[s]))
    return last, cost[last] + ENDING[last][1]


# ---- rows ----

_BLANK = " \t\n\v\f\r"


def kind_of(role: str, text: str, repeated: bool) -> tuple[int, int]:
    """(type, fault) of a row; fault 0 none, 1 blank, 2 duplicate, 3 truncated. The first fault counts."""
    initial = "sua".find(role[:1]) if role else -1
    seen = text.rstrip(_BLANK)
    fault = 1 if not seen else 2 if repeated else 3 if seen[-1] not in ".!?" else 0
    return (initial if initial >= 0 else 3) * 3 + (PLAIN, GOES, GOES, CUT)[fault], fault


def digest(role: str, text: str) -> bytes:
    """Of role and text, the role's length in front so that no two pairs read alike."""
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def rewritten(rows: list[dict], kinds: list[int], first: int, last: int, closes: bool) -> dict:
    """The repaired rows between two states, with their audit; the last stretch also gets what is due at the end."""
    borders = [first, *meet(kinds, first, last), last]
    audit, out, state = [], [], first
    for row, kind, a, b in zip(rows, kinds, borders, borders[1:], strict=False):
        edits = row_edits(kind)[1][a][b]
        audit.append(edits)
        for letter in edits:
            if letter == "I":
                role, state = DUE[state]
                out.append((None, role, ""))
            elif letter == "K":
                state = _kept(kind // 3, state)
                out.append((row["turn"], row["role"], row["text"]))
            elif letter == "R":
                role, state = DUE[state]
                out.append((row["turn"], role, row["text"]))
    if closes:
        audit.append(ENDING[last][0])
        for _ in ENDING[last][0]:
            role, state = DUE[state]
            out.append((None, role, ""))
    return {"audit": "".join(audit), "turn": [t for t, _, _ in out], "role": [r for _, r, _ in out], "text": [t for _, _, t in out]}


def measured(rows: list[dict], faults: list[int]) -> dict:
    """What a stretch adds to its conversation's report; neighbours() adds two of them."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    initials = [r["role"][:1] for r in rows]
    return {"blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3), "turns": len(set(turns)),
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "initial": initials[0], "final": initials[-1],
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))}


def neighbours(a: dict, b: dict) -> dict:
    """The measures of two stretches side by side, rows being in order of turns."""
    return {**{k: a[k] + b[k] for k in ("blank", "duplicate", "truncated")},
            "turns": a["turns"] + b["turns"] - (a["high"] is not None and a["high"] == b["low"]),
            "low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"],
            "initial": a["initial"], "final": b["final"], "illegal": a["illegal"] + b["illegal"] + (a["final"] + b["initial"] not in LEGAL)}


def reported(m: dict, cost: int) -> dict:
    return {"gaps": 0 if m["low"] is None else m["high"] - m["low"] + 1 - m["turns"], **{k: m[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost}


# ---- tables of Spark ----

REPORT = StructType([StructField(c, LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
PIECE = StructType([StructField("audit", StringType()), StructField("turn", ArrayType(LongType())), StructField("role", ArrayType(StringType())), StructField("text", ArrayType(StringType()))])
_WAITING = StructType([*PIECE.fields[1:], StructField("at", ArrayType(IntegerType())), StructField("digests", ArrayType(BinaryType()))])
_MEASURES = StructType([StructField(c, LongType()) for c in ("blank", "duplicate", "truncated", "turns", "low", "high", "illegal")] + [StructField(c, StringType()) for c in ("initial", "final")])
_NODE = StructType([StructField("block", LongType()), StructField("costs", ArrayType(LongType())), StructField("ranks", ArrayType(LongType())), StructField("measures", _MEASURES)])
_CROSSING = StructType([StructField("block", LongType()), StructField("first", IntegerType()), StructField("last", IntegerType()), StructField("closes", BooleanType())])


def _frames(made: Iterator[dict], schema: StructType, rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Dicts as Arrow batches of bounded rows and bytes of text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, held_bytes = to_arrow_schema(schema), [], 0
    for x in made:
        held.append(x)
        held_bytes += x.pop("_bytes", 0)
        if len(held) >= rows or held_bytes >= size:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def _node_table(row: dict) -> Table:
    four = [0, 4, 8, 12]
    return Table(tuple(tuple(row["costs"][i:i + 4]) for i in four), tuple(tuple(row["ranks"][i:i + 4]) for i in four))


def _as_node(conv_id, block: int, table: Table, measures: dict) -> dict:
    return {"conv_id": conv_id, "block": block, "costs": [c for x in table.cost for c in x], "ranks": [r for x in table.rank for r in x], "measures": measures}


class Repair:
    """The repair of turns(conv_id, turn, role, text).

    pieces: (conv_id, block, whole, audit, turn, role, text) is the repaired conversations, cut into pieces of bounded size in order of block; whole says
    that there is no other piece. report: (conv_id, gaps, blank, duplicate, truncated, illegal, cost). Both
    are written tables; conversations without rows are in neither.
    """

    def __init__(self, turns: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES, fan: int = FAN):
        self.spark, self.fan = turns.sparkSession, fan
        one_space = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
        self.id = StructField("conv_id", turns.schema["conv_id"].dataType)
        cut = self._cut(turns.select("conv_id", F.col("turn").cast("long"), *one_space), block_rows, block_bytes)
        done = cut.where("report is not null")
        waiting = cut.where("report is null").select("conv_id", "block", "waiting.*")
        self.report, self.pieces = done.select("conv_id", "report.*"), done.select("conv_id", "block", F.lit(True).alias("whole"), "piece.*")
        found = self._nodes(waiting)
        if found is None:
            return
        blocks, crossings, report = found
        self.report = self.report.unionByName(report)
        self.pieces = self.pieces.unionByName(self._reconstructed(blocks, crossings))

    def _cut(self, turns: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
        """(conv_id, block, report, piece, waiting): conversations inside a block repaired, blocks of the others waiting.

        Blocks count in the order of the rows. The first and last conversation of a partition may go on in the next, so they wait.
        """
        order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
        dealt = turns.repartitionByRange(max(spread(turns, 32), int(self.spark.conf.get("spark.sql.shuffle.partitions"))), *order[:3], F.substring("text", 1, 64).asc())
        schema = StructType([self.id, StructField("block", LongType()), StructField("report", REPORT), StructField("piece", PIECE), StructField("waiting", _WAITING)])

        def repaired(conv_id, block: int, rows: list[dict]) -> dict:
            seen, kinds, faults = set(), [], []
            for r in rows:
                key = (r["role"], r["text"])
                kind, fault = kind_of(*key, key in seen)
                seen.add(key)
                kinds.append(kind)
                faults.append(fault)
            vector, total = over(kinds, START)
            last, cost = ended(vector)
            return {"conv_id": conv_id, "block": block, "report": reported(measured(rows, faults), cost + total), "piece": rewritten(rows, kinds, START, last, True)}

        def waits(conv_id, block: int, rows: list[dict]) -> dict:
            firsts: dict[bytes, int] = {}
            for i, r in enumerate(rows):
                firsts.setdefault(digest(r["role"], r["text"]), i)
            return {"conv_id": conv_id, "block": block, "waiting": {**{c: [r[c] for r in rows] for c in ("turn", "role", "text")}, "at": list(firsts.values()), "digests": list(firsts)}}

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            block = TaskContext.get().partitionId() << 40
            rows: list[dict] = []
            size, open_ = 0, True  # open_: the conversation may have begun earlier
            for batch in batches:
                for row in batch.to_pylist():
                    n = len(row["text"])
                    other = rows and row["conv_id"] != rows[0]["conv_id"]
                    if other or len(rows) >= block_rows or rows and size + n > block_bytes:
                        yield {"_bytes": size, **(repaired if other and not open_ else waits)(rows[0]["conv_id"], block, rows)}
                        block, open_, rows, size = block + 1, not other, [], 0
                    rows.append(row)
                    size += n
            if rows:
                yield {"_bytes": size, **waits(rows[0]["conv_id"], block, rows)}

        return stored(dealt.sortWithinPartitions(*order).mapInArrow(lambda batches: _frames(blocks(batches), schema), schema), "turns")

    def _nodes(self, waiting: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame] | None:
        """(blocks with the types of their rows, the states at both ends of each, reports) of the conversations in several blocks."""
        # blocks are numbered without gaps in the bits: place times the most blocks of a partition
        most = waiting.agg(F.max(F.col("block").bitwiseAND((1 << 40) - 1)).alias("i"), F.max(F.shiftright("block", 40)).alias("p")).first()
        if most.i is None:
            return None
        width = most.i + 1
        number = F.shiftright("block", 40) * width + F.col("block").bitwiseAND((1 << 40) - 1)
        places = waiting.select("conv_id", number.alias("block"), F.explode(F.arrays_zip("digests", "at")).alias("d"))
        first = places.groupBy("conv_id", "d.digests").agg(F.min(F.struct("block", "d.at")).alias("f"))
        fresh = first.groupBy(F.col("f.block").alias("_block")).agg(F.collect_set("f.at").alias("fresh"))
        rows = waiting.drop("at", "digests").withColumn("block", number)
        met = rows.join(fresh, F.col("block") == F.col("_block"), "left").drop("_block")
        fields = [self.id, *_NODE.fields, StructField("kinds", BinaryType())]

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for b in batch.to_pylist():
                    here = set(b["fresh"] or ())
                    rows = [{"turn": t, "role": r, "text": x} for t, r, x in zip(b["turn"], b["role"], b["text"], strict=True)]
                    both = [kind_of(r["role"], r["text"], i not in here) for i, r in enumerate(rows)]
                    kinds = [k for k, _ in both]
                    yield {**_as_node(b["conv_id"], b["block"], table_of(kinds), measured(rows, [f for _, f in both])), "kinds": bytes(kinds)}

        schema = StructType(fields)
        leaves = stored(met.mapInArrow(lambda batches: _frames(typed(batches), schema), schema), "blocks")
        levels = [leaves.drop("kinds")]
        while (most.p + 1) * width > self.fan ** (len(levels) - 1):
            levels.append(stored(self._up(levels[-1], len(levels)), "nodes"))
        crossings = stored(self._top(levels[-1]), "crossings")
        report = crossings.select("conv_id", "report.*")
        crossings = crossings.drop("report")
        for level in range(len(levels) - 1, 0, -1):
            crossings = stored(self._down(levels[level - 1], crossings, level), "crossings")
        return rows.join(leaves.select("block", "kinds"), "block"), crossings, report

    def _parent(self, level: int):
        return F.expr(f"block div {self.fan**level}")

    def _up(self, nodes: DataFrame, level: int) -> DataFrame:
        """Neighbouring nodes of a conversation as one; a parent has the number of its first child."""
        schema = StructType([self.id, *_NODE.fields])

        def join(table: pa.Table) -> pa.Table:
            from pyspark.sql.pandas.types import to_arrow_schema

            rows = sorted(table.to_pylist(), key=lambda r: r["block"])
            made = _as_node(rows[0]["conv_id"], rows[0]["block"], combined([_node_table(r) for r in rows]), functools.reduce(neighbours, [r["measures"] for r in rows]))
            return pa.Table.from_pylist([made], schema=to_arrow_schema(schema))

        return nodes.withColumn("parent", self._parent(level)).groupBy("conv_id", "parent").applyInArrow(join, schema)

    def _top(self, nodes: DataFrame) -> DataFrame:
        """(conv_id, block, first, last, closes, report): each conversation's one node between its ends."""
        schema = StructType([self.id, *_CROSSING.fields, StructField("report", REPORT)])

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for r in batch.to_pylist():
                    table = _node_table(r)
                    last, cost = ended((table.cost[START], table.rank[START]))
                    yield {"conv_id": r["conv_id"], "block": r["block"], "first": START, "last": last, "closes": True, "report": reported(r["measures"], cost)}

        return nodes.mapInArrow(lambda batches: _frames(ends(batches), schema), schema)

    def _down(self, nodes: DataFrame, crossings: DataFrame, level: int) -> DataFrame:
        """The states at both ends of each node, from those of its parent."""
        schema = StructType([self.id, *_CROSSING.fields])

        def part(children: pa.Table, parent: pa.Table) -> pa.Table:
            from pyspark.sql.pandas.types import to_arrow_schema

            rows = sorted(children.to_pylist(), key=lambda r: r["block"])
            ends = parent.to_pylist()[0]
            borders = [ends["first"], *meet([_node_table(r) for r in rows], ends["first"], ends["last"]), ends["last"]]
            made = [{"conv_id": r["conv_id"], "block": r["block"], "first": a, "last": b, "closes": ends["closes"] and r is rows[-1]} for r, a, b in zip(rows, borders, borders[1:], strict=False)]
            return pa.Table.from_pylist(made, schema=to_arrow_schema(schema))

        both = [df.withColumn("parent", self._parent(level)).groupBy("conv_id", "parent") for df in (nodes, crossings)]
        return both[0].cogroup(both[1]).applyInArrow(part, schema)

    def _reconstructed(self, blocks: DataFrame, crossings: DataFrame) -> DataFrame:
        schema = StructType([self.id, StructField("block", LongType()), StructField("whole", BooleanType()), *PIECE.fields])

        def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for b in batch.to_pylist():
                    rows = [{"turn": t, "role": r, "text": x} for t, r, x in zip(b["turn"], b["role"], b["text"], strict=True)]
                    yield {"_bytes": sum(len(r["text"]) for r in rows), "conv_id": b["conv_id"], "block": b["block"], "whole": False, **rewritten(rows, list(b["kinds"]), b["first"], b["last"], b["closes"])}

        met = blocks.join(crossings.drop("conv_id"), "block")
        return stored(met.mapInArrow(lambda batches: _frames(rebuild(batches), schema), schema), "pieces")


def digests(pieces: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the edits of each conversation, and SHA-256 of its ``role:text`` rows joined by newlines.

    The digest of a conversation of several pieces has to be taken in order, so its pieces stream through one task, sorted by Spark
    and held one at a time.
    """
    lines = F.array_join(F.zip_with("role", "text", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    own = pieces.select("conv_id", "block", "whole", "audit", F.size("role").alias("n"), lines.alias("lines"))
    whole = own.where("whole").select("conv_id", "audit", F.sha2("lines", 256).alias("repaired_sha256"))
    schema = whole.schema

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, audit, sha, begun = object(), [], hashlib.sha256(), False
        for batch in batches:
            for r in batch.to_pylist():
                if r["conv_id"] != at:
                    if audit:
                        yield {"conv_id": at, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}
                    at, audit, sha, begun = r["conv_id"], [], hashlib.sha256(), False
                audit.append(r["audit"])
                if r["n"]:
                    sha.update(("\n" if begun else "").encode() + r["lines"].encode())
                    begun = True
        if audit:
            yield {"conv_id": at, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    parts = own.where("not whole").drop("whole")
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return whole.unionByName(parts.mapInArrow(lambda batches: _frames(chain(batches), schema), schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with a fault in a quarter of the rows, chosen by a checksum of ``conv_id:turn`` (nulls: one space).

    Of twenty remainders 0 drops the row, 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats the row,
    4 makes it a user's.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.crc32(F.concat(text[0], F.lit(":"), text[1])) % 20
    rows = conversations.select("conv_id", "turn", text[2].alias("role"), text[3].alias("text"), fault.alias("_fault")).where("_fault <> 0")
    after = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), after.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def repair_damaged(conversations: DataFrame, **sizes: int) -> DataFrame:
    """A row for each conversation of the table, after its damage was repaired: report, audit and digest."""
    done = Repair(damaged(conversations), **sizes)
    found = done.report.withColumnRenamed("conv_id", "_id").join(digests(done.pieces).withColumnRenamed("conv_id", "_same"), F.col("_id").eqNullSafe(F.col("_same"))).drop("_same")
    every = conversations.select("conv_id").distinct()
    met = every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return met.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in REPORT.names], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
