"""Cheapest repair of a conversation's structure, by divide and conquer over four-state cost vectors (Hirschberg).

A repaired conversation's roles read ``(system? (user assistant)+)?``. While it is read, it is in one of four states:
nothing yet, after system, after user, after assistant. A message is kept, given the role that fits, or deleted, and
messages without text may be inserted before any message and at the end. What a run of messages does to the states is
a 4 x 4 table of least costs, and beside it the order of the audits that reach these costs, so that the audit-least of
equally cheap ways can be chosen from either half of a run without writing any audit down: audits of one run that end
in unlike states have a first character in which they differ, for none can begin with another one.

``crossings`` finds the states at all bounds of a sequence of such tables: cost vectors from the left and from the
right meet in the middle, the audit-least cheapest state there is taken, and both halves follow. Space stays linear.
The same function crosses the messages of a piece, the pieces of a block, and the blocks of a conversation, so the
messages of one conversation are spread over tasks like any others.

Messages are range-sorted into blocks of bounded size. Conversations that lie inside a block are finished there; of
the first and last one in each block only the table is passed on (`states`), after which their pieces are finished in
parallel too. What goes through one task for one conversation is one table per block, and for its digest, which must
be taken in order, one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import settle

BLOCK_ROWS = 4_096
BLOCK_BYTES = 8 << 20
PIECE = 32                  # messages whose tables are crossed at once
RANGE_ROWS = 500_000        # of a range, at most about
NEVER = 1 << 40
FORCED, PAD = 8, 9          # codes: 2 * initial + truncated, then: must go, filler
INITIALS = "sua"            # any other initial is 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = [(0, 1), (1, 2), (2, 1)]

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1       # costs; CUT_OFF for a truncated message that stays
_NEXT = (2, 2, 3, 2)        # the state after the only message that can be inserted
_FIT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}      # (state, initial): state after keeping it
END = ("", "II", "I", "")   # insertions that finish a conversation in each state
END_COST = np.array([INSERT * len(x) for x in END], dtype=np.int64)


def _moves(code: int, state: int) -> Iterator[tuple[int, int, str]]:
    """(state after, cost, audit) of every way to take one message; more than two insertions never help."""
    if code == PAD:
        yield state, 0, ""
        return
    initial, cut_off = divmod(code, 2)
    for n in range(3):
        paid, audit = n * INSERT, "I" * n
        yield state, paid + DELETE, audit + "D"
        if code != FORCED:
            if (state, initial) in _FIT:
                yield _FIT[state, initial], paid + KEEP + cut_off * CUT_OFF, audit + "K"
            yield _NEXT[state], paid + REROLE + cut_off * CUT_OFF, audit + "R"
        state = _NEXT[state]


AUDITS = sorted({""} | {a for code in range(10) for state in range(4) for _, _, a in _moves(code, state)})
COST = np.full((10, 4, 4), NEVER, dtype=np.int64)       # of code, state before, state after
RANK = np.zeros((10, 4, 4), dtype=np.int64)             # the place of its audit in AUDITS
for _code in range(10):
    for _state in range(4):
        for _to, _cost, _audit in _moves(_code, _state):
            if (_cost, AUDITS.index(_audit)) < (COST[_code, _state, _to], RANK[_code, _state, _to]):
                COST[_code, _state, _to], RANK[_code, _state, _to] = _cost, AUDITS.index(_audit)


def _advance(cost: np.ndarray, rank: np.ndarray, by_cost: np.ndarray, by_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost vectors (..., 4) and the order of their audits after tables (..., 4, 4)."""
    key = (cost[..., None] + by_cost) * 64 + rank[..., None] * 16 + by_rank
    key = key.min(axis=-2)
    low = key & 63
    return np.minimum(key >> 6, NEVER), (low[..., :, None] > low[..., None, :]).sum(axis=-1)


def transfer(cost: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables (n, 4, 4) of whole sequences (n, length, 4, 4)."""
    total = np.broadcast_to(COST[PAD], (len(cost), 4, 4))
    order = np.zeros((len(cost), 4, 4), dtype=np.int64)
    for i in range(cost.shape[1]):
        total, order = _advance(total, order, cost[:, i, None], rank[:, i, None])
    return total, order


def crossings(cost: np.ndarray, rank: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """States (n, length + 1) at the bounds of sequences of tables (n, length, 4, 4) on the cheapest way from
    ``start`` to ``end``, the audit-least one if there are several.
    """
    n, length = cost.shape[:2]
    at = np.empty((n, length + 1), dtype=np.int64)
    at[:, 0], at[:, -1] = start, end
    every = np.arange(n)

    def halve(lo: int, hi: int) -> None:
        if hi - lo < 2:
            return
        middle = (lo + hi) // 2
        left, order = np.full((n, 4), NEVER), np.zeros((n, 4), dtype=np.int64)
        left[every, at[:, lo]] = 0
        for i in range(lo, middle):
            left, order = _advance(left, order, cost[:, i], rank[:, i])
        right = np.full((n, 4), NEVER)
        right[every, at[:, hi]] = 0
        for i in range(hi - 1, middle - 1, -1):
            right = np.minimum((cost[:, i] + right[:, None, :]).min(axis=2), NEVER)
        at[:, middle] = ((left + right) * 4 + order).argmin(axis=1)
        halve(lo, middle)
        halve(middle, hi)

    halve(0, length)
    return at


def _by_length(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs first[i] to first[i + 1] in groups of like length: (runs, positions (n, length), which are inside)."""
    sizes = np.diff(first)
    lengths = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    for length in np.unique(lengths).tolist():
        runs = np.flatnonzero(lengths == length)
        inside = np.arange(length) < sizes[runs, None]
        yield runs, np.where(inside, first[runs, None] + np.arange(length), 0), inside


class Block:
    """Coded messages of consecutive segments; segment i has messages first[i] to first[i + 1], one at least."""

    def __init__(self, codes: np.ndarray, first: np.ndarray) -> None:
        self.codes, self.first = codes, first
        counts = -(-np.diff(first) // PIECE)
        self.pieces = np.concatenate([[0], np.cumsum(counts)])          # segment i has pieces pieces[i] to pieces[i + 1]
        within = np.arange(self.pieces[-1]) - np.repeat(self.pieces[:-1], counts)
        self.bounds = np.concatenate([np.repeat(first[:-1], counts) + PIECE * within, first[-1:]])
        self.cost, self.rank = self._tables(self.bounds, COST, RANK, codes)
        self.segment_cost, self.segment_rank = self._tables(self.pieces, self.cost, self.rank, None)

    def _tables(self, first: np.ndarray, cost: np.ndarray, rank: np.ndarray, codes: np.ndarray | None):
        out_cost = np.empty((len(first) - 1, 4, 4), dtype=np.int64)
        out_rank = np.empty_like(out_cost)
        for runs, at, inside in _by_length(first):
            out_cost[runs], out_rank[runs] = transfer(*self._of(cost, rank, codes, at, inside))
        return out_cost, out_rank

    @staticmethod
    def _of(cost: np.ndarray, rank: np.ndarray, codes: np.ndarray | None, at: np.ndarray, inside: np.ndarray):
        if codes is not None:
            chosen = np.where(inside, codes[at], PAD)
            return COST[chosen], RANK[chosen]
        here = inside[..., None, None]
        return np.where(here, cost[at], COST[PAD]), np.where(here, rank[at], RANK[PAD])

    def ends(self) -> np.ndarray:
        """The audit-least cheapest last state of each segment taken as a whole conversation."""
        return ((self.segment_cost[:, 0] + END_COST) * 4 + self.segment_rank[:, 0]).argmin(axis=1)

    def ways(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in AUDITS, cost) of what happens to each message on the way of its segment from start to end."""
        piece_start, piece_end = (np.empty(self.pieces[-1], dtype=np.int64) for _ in range(2))
        for runs, at, inside in _by_length(self.pieces):
            states = crossings(*self._of(self.cost, self.rank, None, at, inside), start[runs], end[runs])
            piece_start[at[inside]], piece_end[at[inside]] = states[:, :-1][inside], states[:, 1:][inside]
        before, after = (np.empty(len(self.codes), dtype=np.int64) for _ in range(2))
        for runs, at, inside in _by_length(self.bounds):
            states = crossings(*self._of(COST, RANK, self.codes, at, inside), piece_start[runs], piece_end[runs])
            before[at[inside]], after[at[inside]] = states[:, :-1][inside], states[:, 1:][inside]
        self.before = before
        return RANK[self.codes, before, after], COST[self.codes, before, after]


class Names(NamedTuple):
    conv: str
    turn: str
    role: str
    text: str


def _blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def judged(rows: DataFrame, names: Names) -> DataFrame:
    """(conv, turn, role, text, sign, id, blank, duplicate, truncated) of every message; one of the three at most.

    Of equal role and text in a conversation only the first in order is no duplicate; it is found by a grouped
    minimum and met again by its own number, so no conversation and no common message is a key with many rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (names.role, names.text))
    given = settle(rows.select(F.col(names.conv).alias("conv"), F.col(names.turn).alias("turn"), role.alias("role"), text.alias("text"))
                   .withColumn("sign", F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text"), 256)))
                   .withColumn("id", F.monotonically_increasing_id()), "conversation-rows")
    firsts = given.groupBy("conv", "sign").agg(F.min(F.struct("turn", "id")).alias("least")).select(
        F.col("least.id").alias("first_id"))
    trimmed = _blank(F.col("text"))
    blank = trimmed == ""
    duplicate = ~blank & F.col("first_id").isNull()
    truncated = ~blank & ~duplicate & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    return given.join(firsts, F.col("id") == F.col("first_id"), "left").select(
        *given.columns, blank.alias("blank"), duplicate.alias("duplicate"), truncated.alias("truncated"))


def _segments(conv: list) -> np.ndarray:
    return np.array([0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)], dtype=np.int64)


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(part, messages, open): judged messages in the order of (conv, turn, sign, id), in blocks of bounded size;
    ``open`` has the tables of the first and the last segment, which may go on in other blocks.
    """
    initial = F.coalesce(*(F.when(F.col("role").startswith(c), F.lit(i)) for i, c in enumerate(INITIALS)), F.lit(3))
    coded = rows.select("conv", "turn", "sign", "id", "role", "text", initial.cast("int").alias("initial"), F.when(
        F.col("blank") | F.col("duplicate"), F.lit(FORCED)).otherwise(2 * initial + F.col("truncated").cast("int")).cast("int").alias("code"))
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("sign"), F.col("id")]
    spark = rows.sparkSession
    coded = settle(coded, "conversation-coded")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-coded.count() // RANGE_ROWS))
    ordered = coded.repartitionByRange(width, *keys).sortWithinPartitions(*keys).select(
        F.spark_partition_id().cast("long").alias("partition"), "conv", "role", "text", "initial", "code")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        for batch in batches:
            done = np.concatenate([[0], np.cumsum([len(t.as_buffer()) for t in batch.column("text")])])
            row = 0
            while row < batch.num_rows:
                to = int(np.searchsorted(done, done[row] + BLOCK_BYTES, side="right")) - 1
                to = min(max(to, row + 1), row + block_rows, batch.num_rows)
                part = batch.slice(row, to - row)
                messages = pa.StructArray.from_arrays([part.column(c) for c in fields], names=fields)
                conv = part.column("conv").to_pylist()
                first = _segments(conv)
                tables = Block(part.column("code").to_numpy(), first)
                number = (part.column("partition")[0].as_py() << 33) + block
                opened = [{"conv": conv[first[i]], "segment": i, "cost": tables.segment_cost[i].ravel(),
                           "rank": tables.segment_rank[i].ravel()} for i in sorted({0, len(first) - 2})]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, to - row], pa.int32()), messages).cast(kind.field("messages").type),
                     pa.array([opened], kind.field("open").type)], schema=kind)
                block, row = block + 1, to

    fields = ["conv", "role", "text", "initial", "code"]
    conv = ordered.schema["conv"].dataType.simpleString()
    schema = spark.createDataFrame([], f"part long, messages array<struct<conv: {conv}, role: string, text: string, initial: int, code: int>>, "
                                       f"open array<struct<conv: {conv}, segment: int, cost: array<long>, rank: array<long>>>").schema
    kind = to_arrow_schema(schema)
    return settle(ordered.mapInArrow(pack, schema), "conversation-blocks")


def to_arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema as convert
    return convert(schema)


def states(blocks: DataFrame) -> DataFrame:
    """(part, open): for the open segments of every block the states in which they begin and end on the cheapest way
    of their whole conversation, and whether they are its last.
    """
    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for _, group in groupby(rows, key=lambda r: r["conv"]):
            group = list(group)                                  # one row for each block of one conversation
            length = 1 << (len(group) - 1).bit_length()
            cost, rank = (np.broadcast_to(x[PAD], (1, length, 4, 4)).copy() for x in (COST, RANK))
            cost[0, :len(group)] = np.array([r["cost"] for r in group]).reshape(-1, 4, 4)
            rank[0, :len(group)] = np.array([r["rank"] for r in group]).reshape(-1, 4, 4)
            total, order = transfer(cost, rank)
            end = ((total[:, 0] + END_COST) * 4 + order[:, 0]).argmin(axis=1)
            at = crossings(cost, rank, np.zeros(1, dtype=np.int64), end)[0, :len(group) + 1]
            n = len(group)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["part"] for r in group], pa.int64()), pa.array([r["segment"] for r in group], pa.int32()),
                 pa.array(at[:n], pa.int32()), pa.array(at[1:], pa.int32()), pa.array([False] * (n - 1) + [True])],
                ["part", "segment", "begin", "finish", "final"])

    opened = blocks.select("part", F.explode("open").alias("o")).select("part", "o.*")
    crossed = opened.repartition("conv").sortWithinPartitions("conv", "part", "segment").mapInArrow(
        cross, "part long, segment int, begin int, finish int, final boolean")
    return crossed.groupBy("part").agg(F.array_sort(F.collect_list(         # two at most
        F.struct("segment", "begin", "finish", "final"))).alias("crossed"))


def segments(blocks: DataFrame, with_texts: bool = False) -> DataFrame:
    """Every segment of every block repaired: (conv, part, segment, closed, illegal, cost, first, last, audit, digest,
    messages), where ``messages`` (edit, role, text) is filled for segments that are no whole conversation, or all.
    """
    conv = blocks.schema["messages"].dataType.elementType["conv"].dataType.simpleString()
    schema = blocks.sparkSession.createDataFrame(
        [], f"conv {conv}, part long, segment int, closed boolean, illegal long, cost long, first int, last int, audit string, digest string, "
            "messages array<struct<edit: string, role: string, text: string>>").schema
    kind = to_arrow_schema(schema)
    legal = np.zeros((4, 4), dtype=bool)
    legal[tuple(zip(*LEGAL))] = True

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield mend_block(batch.column("part")[i].as_py(), batch.column("messages")[i].values, batch.column("crossed")[i].as_py())

    def mend_block(part: int, rows: pa.StructArray, crossed: list[dict]) -> pa.RecordBatch:
        ids, roles, texts = (rows.field(c).to_pylist() for c in ("conv", "role", "text"))
        initial, codes = (rows.field(c).to_numpy() for c in ("initial", "code"))
        first = _segments(ids)
        block = Block(codes, first)
        n = len(first) - 1
        start, end, final, closed = np.zeros(n, dtype=np.int64), block.ends(), np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        for x in crossed:
            i = x["segment"]
            start[i], end[i], final[i], closed[i] = x["begin"], x["finish"], x["final"], False
        audits, costs = block.ways(start, end)
        wrong = np.concatenate([[0], np.cumsum(~legal[initial[:-1], initial[1:]])]) if len(initial) else initial
        audits, before = audits.tolist(), block.before.tolist()
        paid = np.add.reduceat(costs, first[:-1])
        out = []
        for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            parts, said = [], []
            for row in range(lo, hi):
                audit, state = AUDITS[audits[row]], before[row]
                parts.append(audit)
                for edit in audit:
                    if edit == "D":
                        continue
                    if edit == "K":
                        said.append((edit, roles[row], texts[row]))
                    else:
                        state = _NEXT[state]
                        said.append((edit, ROLES[INITIALS[state - 1]], texts[row] if edit == "R" else ""))
            cost = int(paid[i])
            if final[i]:
                state, tail = int(end[i]), END[end[i]]
                parts.append(tail)
                cost += INSERT * len(tail)
                for _ in tail:
                    state = _NEXT[state]
                    said.append(("I", ROLES[INITIALS[state - 1]], ""))
            shown = with_texts or not closed[i]
            out.append((ids[lo], part, i, bool(closed[i]), int(wrong[hi - 1] - wrong[lo]), cost, int(initial[lo]), int(initial[hi - 1]),
                        "".join(parts), digest_of(said) if closed[i] else None,
                        [{"edit": e, "role": r, "text": t} for e, r, t in said] if shown else None))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    return blocks.join(states(blocks), "part").select("part", "messages", "crossed").mapInArrow(mend, schema)


def digest_of(messages: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in messages).encode()).hexdigest()


def _joined(pieces: DataFrame) -> DataFrame:
    """Conversations that lie in several blocks, put together in order; the texts pass through one block at a time."""
    schema = pieces.select("conv", "illegal", "cost", "audit", "digest").schema
    kind = to_arrow_schema(schema)
    legal = set(LEGAL)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())
        for conv, group in groupby(rows, key=lambda r: r["conv"]):
            digest, audits, illegal, cost, last, any_yet = hashlib.sha256(), [], 0, 0, None, False
            for r in group:
                audits.append(r["audit"])
                illegal += r["illegal"] + (last is not None and (last, r["first"]) not in legal)
                cost, last = cost + r["cost"], r["last"]
                for m in r["messages"]:
                    digest.update(("\n" * any_yet + f"{m['role']}:{m['text']}").encode())
                    any_yet = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip((conv, illegal, cost, "".join(audits), digest.hexdigest()), kind)], schema=kind)

    return pieces.repartition("conv").sortWithinPartitions("conv", "part", "segment").mapInArrow(join, schema)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    Messages are read by turn, nulls first, and for equal turns by the sha256 of role and text. Null roles and texts
    are one space. A message is blank (no character but white space), else a duplicate (role and text seen earlier in
    the conversation), else truncated (its last such character is none of ``.!?``). ``gaps`` counts missing turns
    between the least and the greatest, ``illegal`` neighbouring messages whose initials are not su, ua or au.

    The audit has one initial for each edit in order: Keep, Rerole, Delete, Insert. A role with another initial, also
    an empty one, cannot be kept. Null conversation ids are one conversation. Repeated rows are duplicates; an empty
    table gives no rows; other columns are not read. ``turn`` must be a number.
    """
    faults = settle(judged(rows, Names(conv_col, turn_col, role_col, text_col)), "conversation-faults")
    counted = faults.groupBy("conv").agg(
        F.coalesce((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long"), F.lit(0).cast("long")).alias("gaps"),
        *(F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")))
    mended = settle(segments(blocks_of(faults, block_rows)), "conversation-segments")
    whole = mended.where("closed").select("conv", "illegal", "cost", "audit", "digest")
    whole = whole.unionByName(_joined(mended.where(~F.col("closed")))).withColumnRenamed("conv", "found")
    return counted.join(whole, F.col("conv").eqNullSafe(F.col("found"))).select(
        F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("digest").alias("repaired_sha256"))


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, part, position, edit, role, text): the messages after repair, as ``repair`` defines it; part and
    position give the order inside a conversation.
    """
    blocks = blocks_of(judged(rows, Names(conv_col, turn_col, role_col, text_col)), block_rows)
    said = segments(blocks, with_texts=True).select("conv", "part", "segment", F.posexplode("messages").alias("at", "m"))
    return said.select(F.col("conv").alias(conv_col), "part", F.col("at").alias("position"), "m.edit", "m.role", "m.text")
