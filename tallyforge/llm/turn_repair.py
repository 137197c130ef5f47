"""Repair of conversations by least-cost edits: rank-convergence Viterbi over chunks of turns.

The roles of a conversation shall read as nothing or as an optional system turn and pairs of user and assistant. An
automaton of four states says so; every turn is kept, given another role or deleted, and empty turns may be put in, each
at a cost. The least costs to go from the four states are a vector that is carried from the last turn to the first.

Long conversations are cut into chunks, which lie in any tasks. Every chunk starts at its end from a guess, the vector of
an ended conversation. Then the vector of each following chunk is known, and passes rerun the chunks whose guess
differs from it by more than a constant, only as far as the new vectors do. Nothing changes any more after one or two
passes, as the vector before some turns hardly depends on what comes after them. Last, the edits are traced forward:
chunks map each state at their start to the state at their end, the maps are chained, and each chunk follows the
least of its edits from its true state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tallyforge.llm.storage import Scratch, prepare

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns in a chunk, at most.
CHUNK_TURNS = 8192
_BLANKS = "' \\t\\n\\x0B\\f\\r'"

# States: nothing yet, after the system turn, after a user turn, after an assistant turn. The state that an inserted turn leads to:
_AFTER = (2, 2, 3, 2)
_NAMES = {2: "user", 3: "assistant"}
_INITIALS = "sua"
_FREE, _CUT, _GONE = 0, 1, 2  # a turn may stay, stays at a charge, has to go


def _closed(costs: list[int]) -> list[int]:
    """Costs with turns put in first where that is cheaper."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_AFTER[s]]) for s, c in enumerate(costs)]
    return costs


_FAR = 1 << 20
#: Costs to go from each state when no turn is left.
ENDED = tuple(_closed([0, _FAR, _FAR, 0]))


@cache
def _edits(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Edits of a turn in ASCII order: letter, cost, next state. Code: what may be done with it, times 4, and its initial."""
    kind, initial = divmod(code, 4)
    out = [("D", DELETE, state)]
    if kind != _GONE:
        charge = TRUNCATED if kind == _CUT else 0
        after = _AFTER[state]
        if state == 0 and initial == 0:
            out.append(("K", KEEP + charge, 1))
        if initial == after - 1:
            out.append(("K", KEEP + charge, after))
        else:
            out.append(("R", REROLE + charge, after))
    return tuple(out)


@cache
def _before(code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs to go before a turn, less the least of them, and that least one."""
    costs = _closed([min(cost + after[state] for _, cost, state in _edits(code, s)) for s in range(4)])
    low = min(costs)
    return tuple(c - low for c in costs), low


def backward(codes: bytes, after: tuple[int, ...]) -> tuple[int, ...]:
    for code in reversed(codes):
        after = _before(code, after)[0]
    return after


def refit(codes: bytes, guess: tuple[int, ...], true: tuple[int, ...], start: tuple[int, ...]) -> tuple[int, ...]:
    """Vector at the start for the true vector at the end; ``start`` belongs to the guess and stands once both agree."""
    for code in reversed(codes):
        guess, true = _before(code, guess)[0], _before(code, true)[0]
        if guess == true:
            return start
    return true


@cache
def _trace_turn(code: int, after: tuple[int, ...], state: int) -> tuple[str, tuple[int, ...], int, int]:
    """Letters of the edits at a turn, ASCII-least of the cheapest, the states they lead to, their cost."""
    costs, low = _before(code, after)
    letters, states, total = "", [], 0
    while True:
        ways = [("I", INSERT, _AFTER[state], INSERT + costs[_AFTER[state]]), *((c, x, s, x + after[s] - low) for c, x, s in _edits(code, state))]
        letter, cost, following, _ = min(w for w in ways if w[3] == costs[state])
        letters, total, state = letters + letter, total + cost, following
        states.append(state)
        if letter != "I":
            return letters, tuple(states), state, total


def _ending(state: int) -> tuple[str, tuple[int, ...]]:
    states = []
    while state not in (0, 3):
        state = _AFTER[state]
        states.append(state)
    return "I" * len(states), tuple(states)


def _vectors(codes: bytes, after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Vector behind each turn."""
    out = [after] * len(codes)
    for i in range(len(codes) - 1, 0, -1):
        out[i - 1] = _before(codes[i], out[i])[0]
    return out


def state_map(codes: bytes, after: tuple[int, ...]) -> list[int]:
    """State at the end for each state at the start."""
    behind, ends = _vectors(codes, after), []
    for state in range(4):
        for code, vector in zip(codes, behind):
            state = _trace_turn(code, vector, state)[2]
        ends.append(state)
    return ends


# Rows of turns in order, one per different turn of a conversation.
_TURN = "turns array<bigint>, roles array<string>, h1 array<bigint>, h2 array<bigint>, codes binary, copies array<bigint>"
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "n_turns"]
_CHUNK = f"part int, chunk bigint, {_TURN}, {', '.join(f'{c} bigint' for c in _COUNTS)}, low bigint, high bigint, first_turn bigint, last_turn bigint, first_initial int, last_initial int, vector array<int>"


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return ((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1))


def _chunked(name: str, limit: int):
    """Sorted turns as chunks, each of one conversation, with what can be counted and the vector of the guess."""

    def table(rows: pa.Table, number: int) -> pa.RecordBatch:
        conv = rows.column(0).combine_chunks()
        names = conv.to_pylist()
        change = np.ones(len(names) + 1, dtype=bool)
        change[1:-1] = [a != b for a, b in zip(names, names[1:])]
        edges = np.flatnonzero(change)
        first, last = edges[:-1], edges[1:] - 1
        turn = rows.column("turn").combine_chunks()
        dated = turn.is_valid().to_numpy(zero_copy_only=False)
        value = turn.fill_null(0).to_numpy(zero_copy_only=False)
        codes, copies = (rows.column(c).to_numpy() for c in ("code", "copies"))
        blank, late = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("blank", "late"))
        initial, cut = codes % 4, codes // 4 == _CUT
        wrong = np.zeros(len(names), dtype=np.int64)
        wrong[1:] = ~_legal(initial[:-1], initial[1:]) & ~change[1:-1]
        # Turns of a conversation lie side by side, those without number first.
        fresh = dated.copy()
        fresh[1:] &= change[1:-1] | ~dated[:-1] | (value[1:] != value[:-1])
        add = lambda x: pa.array(np.add.reduceat(x, first), pa.int64())
        edge = lambda at: turn.take(pa.array(at))
        low = pa.array(np.minimum.reduceat(np.where(dated, value, np.iinfo(np.int64).max), first), mask=~dated[last])
        shape = pa.array(edges, pa.int32())
        lists = [pa.ListArray.from_arrays(shape, rows.column(c).combine_chunks()) for c in ("turn", "role", "h1", "h2")]
        blobs = [codes[a:b].astype(np.uint8).tobytes() for a, b in zip(edges[:-1], edges[1:])]
        columns = {
            name: conv.take(pa.array(first)), "part": pa.array(np.full(len(first), TaskContext.get().partitionId()), pa.int32()),
            "chunk": pa.array(number + np.arange(len(first))), "turns": lists[0], "roles": lists[1], "h1": lists[2], "h2": lists[3],
            "codes": pa.array(blobs, pa.binary()), "copies": pa.ListArray.from_arrays(shape, pa.array(copies, pa.int64())),
            "blank": add(np.where(blank, copies, 0)), "duplicate": add(np.where(blank, 0, np.where(late, copies, copies - 1))),
            "truncated": add(cut.astype(np.int64)), "illegal": add(wrong + copies - 1), "n_turns": add(fresh.astype(np.int64)),
            "low": low, "high": edge(last), "first_turn": edge(first), "last_turn": edge(last),
            "first_initial": pa.array(initial[first], pa.int32()), "last_initial": pa.array(initial[last], pa.int32()),
            "vector": pa.array([backward(b, ENDED) for b in blobs], pa.list_(pa.int32())),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, number = [], 0, 0
        for batch in batches:
            for piece in pa.Table.from_batches([batch]).to_batches(max_chunksize=limit):
                if size + len(piece) > limit:
                    out = table(pa.Table.from_batches(waiting), number)
                    yield out
                    waiting, size, number = [], 0, number + len(out)
                waiting.append(piece)
                size += len(piece)
        if size:
            yield table(pa.Table.from_batches(waiting), number)

    return run


def _refitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, guess, true, start = (batch.column(c).to_pylist() for c in ("codes", "guess", "following", "vector"))
        found = [list(refit(c, tuple(g), tuple(t), tuple(s))) for c, g, t, s in zip(codes, guess, true, start)]
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("chunk"), pa.array(found, pa.list_(pa.int32()))], ["part", "chunk", "refitted"])


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [state_map(c, tuple(v)) for c, v in zip(batch.column("codes").to_pylist(), batch.column("guess").to_pylist())]
        at = batch.schema.get_field_index("codes")
        yield batch.set_column(at, "map", pa.array(maps, pa.list_(pa.int32()))).drop_columns(["guess"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State at the start of each chunk, of conversations whose chunks come in order."""
    conv, state, begun = None, 0, False
    for batch in batches:
        states = []
        for name, ends in zip(batch.column(0).to_pylist(), batch.column("map").to_pylist()):
            if not begun or name != conv:
                conv, state, begun = name, 0, True
            states.append(state)
            state = ends[state]
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("chunk"), pa.array(states, pa.int32())], ["part", "chunk", "state"])


_EDIT = "array<struct<number: int, action: string, copies: bigint, turn: bigint, old_role: string, role: string, h1: bigint, h2: bigint>>"


def _traced(name: str):
    """Edits of each chunk from its true state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                codes, state, letters, cost, edits = row["codes"], row["state"], [], 0, []

                def put(actions, states, i=None, row=row, edits=edits):
                    for action, reached in zip(actions, states):
                        own = i is not None and action != "I"
                        old = row["roles"][i] if own else None
                        edits.append({
                            "number": len(edits), "action": action, "copies": 1, "turn": row["turns"][i] if own else None, "old_role": old,
                            "role": old if action in "KD" else _NAMES[reached], "h1": row["h1"][i] if own else None, "h2": row["h2"][i] if own else None,
                        })

                for i, (code, after) in enumerate(zip(codes, _vectors(codes, tuple(row["guess"])))):
                    actions, states, state, more = _trace_turn(code, after, state)
                    put(actions, states, i)
                    letters.append(actions)
                    cost += more
                    if row["copies"][i] > 1:
                        letters.append("D" * (row["copies"][i] - 1))
                        cost += DELETE * (row["copies"][i] - 1)
                        put("D", (state,), i)
                        edits[-1]["copies"] = row["copies"][i] - 1
                if row["last"]:
                    actions, states = _ending(state)
                    put(actions, states)
                    letters.append(actions)
                    cost += INSERT * len(actions)
                out.append((cost, "".join(letters), edits))
            columns = [batch.column(c) for c in (name, "part", "chunk")]
            costs, audits, lists = zip(*out) if out else ((), (), ())
            kind = pa.list_(pa.struct([
                ("number", pa.int32()), ("action", pa.string()), ("copies", pa.int64()), ("turn", pa.int64()), ("old_role", pa.string()), ("role", pa.string()),
                ("h1", pa.int64()), ("h2", pa.int64()),
            ]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(lists, kind)], [name, "part", "chunk", "cost", "audit", "edits"])

    return run


@dataclass
class Repair:
    """``summary``: per conversation ``gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``edits``: one row per edit, with ``position`` (orders the edits of a conversation), ``action`` (K, R, D, I), ``copies`` (equal turns
    deleted at once), ``turn``, ``role`` (the new one). ``turns``: what is left, with ``text``; put-in turns have an empty one.
    """

    summary: DataFrame
    edits: DataFrame
    turns: DataFrame


def joined(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns, NULL to NULL too; they come once."""
    own = right.select(*(F.col(c).alias(f"_key_{c}") for c in columns), *(c for c in right.columns if c not in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    return left.join(own, same, how).drop(*(f"_key_{c}" for c in columns))


def repair_turns(rows: DataFrame, id_column: str = "conv_id", chunk_turns: int = CHUNK_TURNS) -> Repair:
    """Audit and repair conversations given as rows of ``id_column``, ``turn``, ``role``, ``text``; other columns are not read.

    The turns of a conversation are taken by ``turn`` (NULLs first; rows of one turn by role, then by a hash of the text). NULL in role
    or text counts as one space; rows with a NULL id form one conversation. A turn's first fault counts: blank (nothing but white space),
    duplicate (role and text came earlier), truncated (does not end in . ! or ?). Equal rows are counted before anything is
    sorted, so any number of copies of one is a single turn with its copies behind it. No rows give no conversations.

    Turns are dealt by range of conversation, turn, role and text hash, so one long conversation spreads over tasks. Texts are compared by
    128 bits of hash and move once, to the edits that keep them. The audit of a conversation is one string.
    """
    spark = rows.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "turn-repair")
    text = F.coalesce(F.col("text"), F.lit(" "))
    bare = F.expr(f"rtrim({_BLANKS}, coalesce(text, ' '))")
    turns = rows.select(
        F.col(f"`{id_column}`"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("turn"), text).alias("h2"), text.alias("text"), bare.alias("bare"),
    )
    key = [id_column, "turn", "role", "h1", "h2"]
    ends = F.right("bare", F.lit(1))
    single = turns.groupBy(*key, (F.col("bare") == "").alias("blank"), ends.isin(".", "!", "?").alias("closed")).agg(F.count(F.lit(1)).alias("copies"))
    content = [id_column, "role", "h1", "h2"]
    firsts = single.groupBy(*content).agg(F.min("turn").alias("_first"), F.max(F.col("turn").isNull()).alias("_undated"))
    late = F.when(F.col("_undated"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_first"))
    initial = F.left("role", F.lit(1))
    kind = F.when(F.col("blank") | F.col("late"), _GONE).when(~F.col("closed"), _CUT).otherwise(_FREE)
    marked = joined(single, firsts, content).select(*key, "blank", "closed", "copies", late.alias("late")).withColumn("code", (kind * 4 + F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)).cast("int"))
    ordered = marked.repartitionByRange(*key).sortWithinPartitions(*key)
    chunk_schema = StructType([rows.schema[id_column], *DataType.fromDDL(_CHUNK).fields])
    chunks = scratch.save(ordered.mapInArrow(_chunked(id_column, chunk_turns), chunk_schema))

    vectors = _converged(chunks, id_column, scratch)
    states = (
        chunks.join(vectors.where("not single"), ["part", "chunk"]).select(id_column, "part", "chunk", "codes", "guess")
        .mapInArrow(_mapped, StructType([rows.schema[id_column], *DataType.fromDDL("part int, chunk bigint, map array<int>").fields]))
        .repartition(id_column).sortWithinPartitions(id_column, "part", "chunk").mapInArrow(_chained, "part int, chunk bigint, state int")
    )
    known = scratch.save(vectors.where("not single").join(states, ["part", "chunk"]).select("part", "chunk", "guess", "state", "last"))
    ready = chunks.join(known, ["part", "chunk"], "left").select(
        id_column, "part", "chunk", "turns", "roles", "h1", "h2", "codes", "copies", F.coalesce("guess", F.array(*map(F.lit, ENDED))).alias("guess"),
        F.coalesce("state", F.lit(0)).alias("state"), F.coalesce("last", F.lit(True)).alias("last"),
    )
    traced_schema = StructType([rows.schema[id_column], *DataType.fromDDL(f"part int, chunk bigint, cost bigint, audit string, edits {_EDIT}").fields])
    traced = scratch.save(ready.mapInArrow(_traced(id_column), traced_schema))

    listed = traced.select(id_column, "part", "chunk", F.explode("edits").alias("e")).select(
        id_column, (F.shiftleft(F.col("part").cast("long"), 43) + F.shiftleft("chunk", 16) + F.col("e.number")).alias("position"), "e.*"
    )
    texts = turns.groupBy(*key).agg(F.first("text").alias("text"))
    kept = listed.where("action in ('K', 'R')").withColumn("_new", F.col("role")).withColumn("role", F.col("old_role"))
    stayed = joined(kept, texts, key).select(id_column, "position", "turn", "action", F.col("_new").alias("role"), "text")
    put_in = listed.where("action = 'I'").select(id_column, "position", "turn", "action", "role", F.lit("").alias("text"))
    edits = listed.select(id_column, "position", "action", "copies", "turn", "role")
    return Repair(_summary(chunks, traced, id_column), edits, stayed.unionByName(put_in))


def _converged(chunks: DataFrame, id_column: str, scratch: Scratch) -> DataFrame:
    """``part, chunk``, the vector behind each chunk as ``guess``, whether it is the ``last`` one and the ``single`` one of its conversation."""
    order = Window.partitionBy(id_column).orderBy("part", "chunk")
    ended = F.array(*map(F.lit, ENDED))
    current = chunks.select(id_column, "part", "chunk", "vector", ended.alias("guess"))
    while True:
        following = F.lead("vector").over(order)
        current = scratch.save(current.withColumns({
            "following": F.coalesce(following, ended), "last": following.isNull(), "single": following.isNull() & F.lag("vector").over(order).isNull(),
        }))
        wrong = current.where("following != guess")
        if wrong.isEmpty():
            return current.select("part", "chunk", "guess", "last", "single")
        again = chunks.select("part", "chunk", "codes").join(wrong.select("part", "chunk", "guess", "following", "vector"), ["part", "chunk"])
        fixed = again.mapInArrow(_refitted, "part int, chunk bigint, refitted array<int>")
        current = current.join(fixed, ["part", "chunk"], "left").select(
            id_column, "part", "chunk", F.coalesce("refitted", "vector").alias("vector"), F.col("following").alias("guess")
        )


def _summary(chunks: DataFrame, traced: DataFrame, id_column: str) -> DataFrame:
    """Counts, cost and audit of each conversation from those of its chunks."""
    order = Window.partitionBy(id_column).orderBy("part", "chunk")
    before, turn = F.lag("last_initial").over(order), F.lag("last_turn").over(order)
    pair = F.concat(before.cast("string"), F.col("first_initial").cast("string"))
    counted = chunks.withColumns({"_wrong": F.coalesce(~pair.isin("01", "12", "21"), F.lit(False)).cast("long"), "_again": F.coalesce(turn == F.col("first_turn"), F.lit(False)).cast("long")})
    sums = counted.groupBy(id_column).agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum(F.col("n_turns") - F.col("_again")), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum(F.col("illegal") + F.col("_wrong")).alias("illegal"),
    )
    audits = traced.groupBy(id_column).agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "chunk", "audit"))), lambda x: x["audit"]), "").alias("audit")
    )
    return joined(sums, audits, [id_column])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, hashed = None, None
    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        done: list[tuple] = []
        for name, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if hashed is None or name != conv:
                if hashed is not None:
                    done.append((conv, hashed.hexdigest()))
                conv, hashed = name, hashlib.sha256()
            else:
                hashed.update(b"\n")
            hashed.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], [batch.schema.names[0], "repaired_sha256"])
    if hashed is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([hashed.hexdigest()], pa.string())], [batch.schema.names[0], "repaired_sha256"])


def digest_turns(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """SHA-256 of the ``role:text`` lines of each conversation; its turns stream through one task in order, as the digest asks, and none are held."""
    rows = turns.select(id_column, "role", "text", "position").repartition(id_column).sortWithinPartitions(id_column, "position").drop("position")
    return rows.mapInArrow(_digested, StructType([turns.schema[id_column], StructField("repaired_sha256", DataType.fromDDL("string"))]))
