"""Conversation structure repair by Hirschberg's divide and conquer.

The turns of a conversation are edited so that their roles read ``system`` at most
once, at the start, and then ``user`` and ``assistant`` in turns, ending with
``assistant`` (or that nothing is left). What comes before a turn matters only by the
last role: four states (start, system, user, assistant). A turn is a step that leads
from each state to each other one at a least cost, with zero to two turns inserted in
front of it. Of a range of turns, a forward vector (least cost from the state at its
start to each state in its middle) and a backward vector (least cost from there to the
state at its end) meet in the middle; the state with the least sum is crossed, and both
halves are solved alike. So a task keeps four numbers a side, not a table.

Equal costs are settled by the audit (the initials of all edits), which has to be the
least in ASCII order. Audits up to one border have equally many turns and end with a
turn's edit, so none is the beginning of another one; for the forward vector the order
of its (at most four) least audits is enough. A step's own order is by its edits.

Steps compose: a block of ``BLOCK`` turns is one step with the same numbers. Long
conversations are reduced block by block to layers, as short ones are, and the layers are
solved from the top: the crossings of one layer are the ends of the blocks below. No
task holds a conversation; only the digest of the repaired text is made by one task
a conversation, which streams it in order, since a digest cannot be made in parts.

Defined results: a null role or text is one space; rows without ``conv_id`` are one
conversation; turns are in the order of ``turn`` (nulls first), equal ones by role and text.
A role that does not begin with s, u or a cannot be kept, nor can an empty one. An empty
table has no conversations. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import SLICE_BYTES, pick, placed_rows, ship, text_slices, written

# Turns (or steps of a layer) that one block holds.
SHIFT = 10
BLOCK = 1 << SHIFT
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("", "system", "user", "assistant")
# Keep: from which state a role's initial leads where.
KEEP = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
INITIALS = "sua"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
# Inserted turns that make the roles complete behind the last turn, by its state.
TAIL = (0, 2, 1, 0)
NEVER = 1 << 60
WHITE = " \t\n\v\f\r"
# The start of a text, of all keys by which equal turns are ordered.
PREFIX = 64


@lru_cache(maxsize=None)
def turn_edits(code: int):
    """``{(from, to): (cost, edits)}`` of a turn with ``code`` = initial * 4 + fault."""
    initial, fault = divmod(code, 4)
    found = {}
    for start in STATES:
        state, cost, edits = start, 0, ""
        for _ in range(3):
            ways = [(state, DELETE_COST, "D")]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                if state in KEEP[initial]:
                    ways.append((KEEP[initial][state], more, "K"))
                ways.append((NEXT[state], REROLE_COST + more, "R"))
            for to, price, edit in ways:
                way = (cost + price, edits + edit)
                found[start, to] = min(found.get((start, to), way), way)
            state, cost, edits = NEXT[state], cost + INSERT_COST, edits + "I"
    return found


@lru_cache(maxsize=None)
def turn_step(code: int):
    """The step of a turn: for each state, ``(cost, order of the edits)`` to each state."""
    edits = turn_edits(code)
    step = []
    for start in STATES:
        texts = sorted(e for (s, _), (_, e) in edits.items() if s == start)
        step.append(
            tuple(
                (edits[start, to][0], texts.index(edits[start, to][1]))
                if (start, to) in edits
                else (NEVER, 0)
                for to in STATES
            )
        )
    return tuple(step)


def forward(steps, first: int):
    """``(cost, order of the audit)`` of each state after ``steps`` from state ``first``."""
    vector = [(NEVER, 0)] * 4
    vector[first] = (0, 0)
    for step in steps:
        ways = []
        for to in STATES:
            ways.append(
                min(
                    (cost + step[state][to][0], order, step[state][to][1])
                    for state, (cost, order) in enumerate(vector)
                )
            )
        audits = sorted(way[1:] for way in ways if way[0] < NEVER)
        vector = [
            (way[0], audits.index(way[1:])) if way[0] < NEVER else (NEVER, 0) for way in ways
        ]
    return vector


def backward(steps, last: int):
    """The least cost from each state through ``steps`` to state ``last``."""
    costs = [NEVER] * 4
    costs[last] = 0
    for step in reversed(steps):
        costs = [
            min(NEVER, *(step[state][to][0] + costs[to] for to in STATES)) for state in STATES
        ]
    return costs


def composed(steps):
    """All ``steps`` as one step."""
    return tuple(tuple(forward(steps, state)) for state in STATES)


def crossings(steps, first: int, last: int) -> list[int]:
    """The states at all borders of ``steps`` on the cheapest way with the least audit."""
    states = [first] * len(steps) + [last]
    ranges = [(0, len(steps))]
    while ranges:
        low, high = ranges.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        ahead = forward(steps[low:middle], states[low])
        behind = backward(steps[middle:high], states[high])
        states[middle] = min(STATES, key=lambda s: (ahead[s][0] + behind[s], ahead[s][1]))
        ranges += [(low, middle), (middle, high)]
    return states


def last_state(step) -> int:
    """Where a whole conversation ends best, with the turns inserted behind it."""
    ends = step[START]
    return min(STATES, key=lambda s: (ends[s][0] + INSERT_COST * TAIL[s], ends[s][1]))


# Most conversations are short and have few patterns of roles and faults.
@lru_cache(maxsize=1 << 14)
def _turns_composed(codes: bytes):
    return composed([turn_step(c) for c in codes])


@lru_cache(maxsize=1 << 14)
def _turns_crossed(codes: bytes, first: int, last: int):
    return crossings([turn_step(c) for c in codes], first, last)


def _flat(step):
    return [number for row in step for pair in row for number in pair]


def _step(flat):
    return tuple(
        tuple((flat[8 * s + 2 * t], flat[8 * s + 2 * t + 1]) for t in STATES) for s in STATES
    )


def _runs(batches, names, keys):
    """Consecutive rows with equal ``keys``, as tuples in the order of ``names``."""
    parts = (
        part
        for batch in batches
        for part in (text_slices(batch, "text") if "text" in names else [batch])
    )
    rows = (row for part in parts for row in zip(*[part.column(n).to_pylist() for n in names]))
    return groupby(rows, lambda row: row[:keys])


def _batch(rows, schema):
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _emitted(rows, schema, size=4096):
    """Arrow batches of ``size`` rows, or fewer of long texts in the last column."""
    held, characters = [], 0
    for row in rows:
        held.append(row)
        characters += len(row[-1]) if isinstance(row[-1], str) else 0
        if len(held) == size or characters > SLICE_BYTES:
            yield _batch(held, schema)
            held, characters = [], 0
    if held:
        yield _batch(held, schema)


_MEMBERS = ["conv", "block", "kind", "pos", "n", "code", "step", "first", "last"]
_LAYER = "conv string, pos bigint, n bigint, step array<bigint>"
_LAYER_ARROW = pa.schema(
    [("conv", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("step", pa.list_(pa.int64()))]
)
_ENDS = "conv string, pos bigint, code int, first int, last int"
_ENDS_ARROW = pa.schema(
    [
        ("conv", pa.string()),
        ("pos", pa.int64()),
        ("code", pa.int32()),
        ("first", pa.int32()),
        ("last", pa.int32()),
    ]
)


def _reduce_blocks(batches):
    """The step of each block of turns or of steps."""

    def rows():
        for (conv, block), members in _runs(batches, ["conv", "block", "n", "code", "step"], 2):
            members = list(members)
            if members[0][3] is not None:
                step = _turns_composed(bytes(m[3] for m in members))
            else:
                step = composed([_step(m[4]) for m in members])
            yield conv, block, -(-members[0][2] // BLOCK), _flat(step)

    return _emitted(rows(), _LAYER_ARROW)


def _solve_blocks(batches):
    """The states before and behind every member of each block."""

    def rows():
        for (conv, _), found in _runs(batches, _MEMBERS, 2):
            (_, _, _, _, _, _, _, first, last), *members = found
            if members[0][5] is not None:
                states = _turns_crossed(bytes(m[5] for m in members), first, last)
            else:
                states = crossings([_step(m[6]) for m in members], first, last)
            for i, member in enumerate(members):
                yield conv, member[3], member[5], states[i], states[i + 1]

    return _emitted(rows(), _ENDS_ARROW)


def _whole_ends(batches):
    """The first and last state of each conversation, from its one step."""

    def rows():
        for _, found in _runs(batches, ["conv", "step"], 1):
            for conv, step in found:
                yield conv, 0, None, START, last_state(_step(step))

    return _emitted(rows(), _ENDS_ARROW)


def _blocked(members: DataFrame) -> DataFrame:
    return members.withColumn("block", F.shiftright("pos", SHIFT))


def _together(rows: DataFrame, keys, order) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def solve_turns(turns: DataFrame) -> DataFrame:
    """``(conv, pos, code, first, last)``: the states around ``turns(conv, pos, n, code)``."""
    none = F.lit(None)
    layer = turns.select("conv", "pos", "n", "code", none.cast("array<bigint>").alias("step"))
    layers, largest = [layer], turns.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = _together(_blocked(layers[-1]), ["conv", "block"], ["pos"])
        above = written(blocks.mapInArrow(_reduce_blocks, _LAYER), "conversation-layer")
        layers.append(above.withColumn("code", none.cast("int")))
        largest = -(-largest // BLOCK)
        if largest <= 1:
            break
    ends = layers.pop().mapInArrow(_whole_ends, _ENDS)
    for layer in reversed(layers):
        # The ends of a block come before its members.
        outer = ends.select("conv", F.col("pos").alias("block"), "first", "last")
        both = (
            _blocked(layer)
            .withColumn("kind", F.lit(1))
            .unionByName(outer.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        )
        members = _together(both.select(*_MEMBERS), ["conv", "block"], ["kind", "pos"])
        ends = written(members.mapInArrow(_solve_blocks, _ENDS), "conversation-ends")
    return ends


def _text(column):
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """A test of the repair: turns of ``(conv_id, turn, role, text)`` lost, emptied, cut,
    repeated or given another role, by the checksum of ``conv_id:turn``."""
    spot = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn")))) % 20
    made = rows.select("conv_id", "turn", "role", "text", spot.alias("spot")).filter("spot <> 0")
    text = F.col("text")
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return made.select(
        "conv_id",
        "turn",
        F.when(F.col("spot") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("spot") == 1, F.lit(""))
        .when(F.col("spot") == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.when(F.col("spot") == 3, twice).otherwise(once)).alias("copy"),
    ).drop("copy")


def _key(conv_id):
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("-"))


def _judged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in their order, and ``(conv, pos, n, code)`` with the fault of each."""
    said = rows.select(
        _key(F.col("conv_id")).alias("conv"),
        "turn",
        _text(F.col("role")).alias("role"),
        _text(F.col("text")).alias("text"),
    )
    said = said.withColumns(
        {
            "start": F.substring("text", 1, PREFIX),
            "same": F.sha2(
                F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256
            ),
            "nth": F.monotonically_increasing_id(),
        }
    )
    order = [F.col("turn").asc_nulls_first(), "role", "start", "same", "nth"]
    placed = written(placed_rows(said, "conv", order).drop("start", "nth"), "conversation-turns")
    core = F.rtrim("text", F.lit(WHITE))
    slim = placed.select(
        "conv",
        "pos",
        "n",
        "same",
        F.when(core == "", BLANK)
        .when(~F.right(core, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
        .alias("fault"),
        (F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1).alias("initial"),
        (F.col("role") == "").alias("unnamed"),
    )
    # Only what was said more than once meets again.
    again = (
        slim.filter(F.col("fault") != BLANK)
        .groupBy("conv", "same")
        .agg(F.min("pos").alias("earliest"), F.count("*").alias("times"))
        .filter("times > 1")
        .drop("times")
    )
    fault = F.when(
        (F.col("fault") != BLANK) & (F.col("pos") > F.col("earliest")), DUPLICATE
    ).otherwise(F.col("fault"))
    other = F.col("unnamed") | (F.col("initial") < 0)
    code = F.when(other, len(INITIALS)).otherwise(F.col("initial")) * 4 + fault
    found = slim.join(again, ["conv", "same"], "left").select(
        "conv", "pos", "n", code.cast("int").alias("code")
    )
    return placed.drop("same"), written(found, "conversation-codes")


_STREAM = ["conv", "pos", "kind", "turn", "role", "text", "code", "first", "last"]
_EDITS = (
    "conv string, nth bigint, edit string, cost bigint, turn bigint, first_of_turn boolean, "
    "fault int, illegal boolean, role string, text string"
)
_EDITS_ARROW = pa.schema(
    [
        ("conv", pa.string()),
        ("nth", pa.int64()),
        ("edit", pa.string()),
        ("cost", pa.int64()),
        ("turn", pa.int64()),
        ("first_of_turn", pa.bool_()),
        ("fault", pa.int32()),
        ("illegal", pa.bool_()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)
_LEGAL = {"su", "ua", "au"}


def _edit_rows(batches):
    """The edits of every conversation in order; one without an edit opens each."""

    def rows():
        for (conv,), found in _runs(batches, _STREAM, 1):
            yield conv, -1, "", 0, None, False, None, False, None, None
            nth, state, before, last_turn, open_turn = 0, START, None, None, None
            for _, _, kind, turn, role, text, code, first, last in found:
                if kind == 1:
                    open_turn = (code, first, last)
                if kind != 2:
                    continue
                code, first, last = open_turn
                cost, edits = turn_edits(code)[first, last]
                fault = code % 4
                illegal = before is not None and before + role[:1] not in _LEGAL
                new_turn = turn is not None and turn != last_turn
                state = first
                for edit in edits[:-1]:
                    state = NEXT[state]
                    yield conv, nth, edit, INSERT_COST, None, False, None, False, ROLE[state], ""
                    nth, cost = nth + 1, cost - INSERT_COST
                kept = role if edits[-1] == "K" else ROLE[NEXT[state]] if edits[-1] == "R" else None
                yield (
                    conv, nth, edits[-1], cost, turn, new_turn, fault, illegal,
                    kept, None if kept is None else text,
                )
                nth, state, before = nth + 1, last, role[:1]
                last_turn = turn if turn is not None else last_turn
            for _ in range(TAIL[state]):
                state = NEXT[state]
                yield conv, nth, "I", INSERT_COST, None, False, None, False, ROLE[state], ""
                nth += 1

    return _emitted(rows(), _EDITS_ARROW, 512)


def conversation_edits(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """All edits of ``rows(conv_id, turn, role, text)``, in order within a partition.

    ``(conv, nth, edit, cost, turn, first_of_turn, fault, illegal, role, text)``: ``role``
    and ``text`` are those of the repaired turn, null for a deleted one; ``conv`` is the
    id as text behind ``=``, ``-`` for null. Each conversation begins with a row without an edit
    (``nth`` -1), also those of ``every(conv)`` that have no turn.
    """
    placed, codes = _judged(rows)
    states = solve_turns(codes)
    streams = placed.select("conv", "pos", "turn", "role", "text").withColumn("kind", F.lit(2))
    streams = streams.unionByName(states.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    if every is not None:
        opening = every.select("conv").withColumns(
            {"pos": F.lit(-1).cast("bigint"), "kind": F.lit(0)}
        )
        streams = streams.unionByName(opening, allowMissingColumns=True)
    return _together(
        streams.select(*[F.col(c).cast("bigint") if c == "turn" else c for c in _STREAM]),
        ["conv"],
        ["pos", "kind"],
    ).mapInArrow(_edit_rows, _EDITS)


_REPORT = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)
_REPORT_ARROW = pa.schema(
    [
        ("conv", pa.string()),
        *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)


def _report_rows(batches):
    def rows():
        for (conv,), found in _runs(batches, _EDITS_ARROW.names, 1):
            faults, illegal, cost, distinct = [0] * 4, 0, 0, 0
            least = most = None
            audit, text, lines = bytearray(), hashlib.sha256(), 0
            for _, _, edit, price, turn, new_turn, fault, wrong, role, said in found:
                cost += price
                illegal += wrong
                distinct += new_turn
                if fault is not None:
                    faults[fault] += 1
                if turn is not None:
                    least = turn if least is None else least
                    most = turn
                audit += edit.encode()
                if role is not None:
                    text.update(f"{chr(10) if lines else ''}{role}:{said}".encode())
                    lines += 1
            gaps = most - least + 1 - distinct if most is not None else 0
            yield conv, gaps, *faults[1:], illegal, cost, audit.decode(), text.hexdigest()

    return _emitted(rows(), _REPORT_ARROW, 256)


def conversation_reports(edits: DataFrame) -> DataFrame:
    """One row a conversation of :func:`conversation_edits`, which must come in its order."""
    return edits.mapInArrow(_report_rows, _REPORT)


def op12_query(spark, sf_dir) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = pick(table, conv_id="conv_id", turn="turn", role="role", text="text")
    every = rows.select(_key(F.col("conv_id")).alias("conv")).distinct()
    reports = conversation_reports(conversation_edits(damaged(rows), every))
    id_type = rows.schema["conv_id"].dataType
    conv_id = F.when(F.col("conv") != "-", F.expr("substr(conv, 2)")).cast(id_type)
    return reports.select(conv_id.alias("conv_id"), *[c for c in reports.columns if c != "conv"])


ship(__name__)
