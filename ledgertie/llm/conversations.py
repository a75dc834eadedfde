"""Repair of conversations by the cheapest edits, with a parallel Viterbi pass.

A conversation is legal if its roles read: perhaps a system turn, then user and assistant
in turn, ending with the assistant; or nothing. Rows may be kept (0), given the other
role (3) or deleted (4), empty turns may be inserted (3), and a truncated row that stays
adds 3. Blank rows and repeated ones must go. Of the cheapest ways the one whose letters
are least is taken: D before I before K before R.

The costs of the rest of a conversation, from each of four states (nothing yet, after the
system turn, after a user, after an assistant), follow from those one row further. Rows
are sorted and cut into chunks, so a conversation of any length spreads over tasks. Every
chunk starts from a speculative vector of costs at its end. Passes then give each chunk
the vector that the next one found; a chunk runs again if that differs from its own by
more than a constant, until none does. Vectors forget their start within a few rows, so
one or two passes do; only a chunk none of whose rows tells states apart passes a vector
on, one chunk a pass. The stitched backward costs then drive the tracing from the front:
a chunk is traced from each state it might be entered in, and a fold over one small row
per chunk tells which one holds.

Rows that are alike are counted before they are sorted, so copies never meet in a task.
The digest of a repaired conversation is one SHA-256 over all its lines, which by its
definition runs in order: its rows stream through one task, batch by batch.

Defined results: nulls in role and text are one space, as they are in the text that damage
is drawn by; null ids are one conversation; rows of one turn are ordered by the MD5 of the
length of their role, a colon, role and text; a null turn comes first; an empty table has
no conversations. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertie.llm.tables import materialise

CHUNK_BITS = 12  # a chunk has at most 2 ** 12 rows that differ
KEEP, OTHER_ROLE, INSERT, DELETE, CUT_SHORT = 0, 3, 3, 4, 3
OK, TRUNCATED, BLANK, REPEATED = range(4)  # what is wrong with a row
SYSTEM, USER, ASSISTANT, OTHER = range(4)  # the initial of a row's role
NOTHING, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)  # states
ROLE_NAMES = {"u": "user", "a": "assistant"}
NEVER = 1 << 20
BLANKS = r"\x20\x09-\x0D"

ROWS = "array<struct<at: long, code: int, n: long, turn: long, h: string>>"
CHUNK = f"conv_id {{kind}}, chunk long, rows {ROWS}, single boolean, last boolean"
VECTORS = f"{CHUNK}, end array<int>, first array<int>"
Costs = tuple[int, int, int, int]


def _closed(costs: list[int]) -> list[int]:
    """Costs where turns may be inserted first: a user everywhere but after a user."""
    user = min(costs[AFTER_USER], INSERT + costs[AFTER_ASSISTANT])
    assistant = min(costs[AFTER_ASSISTANT], INSERT + user)
    return [
        min(costs[NOTHING], INSERT + user),
        min(costs[AFTER_SYSTEM], INSERT + user),
        user,
        assistant,
    ]


def _next(state: int) -> int:
    """Where the one turn that a state allows, besides the system's, leads."""
    return AFTER_ASSISTANT if state == AFTER_USER else AFTER_USER


def _kept(state: int, initial: int) -> int | None:
    """Where keeping a row with this initial leads, if the state allows it."""
    if initial == SYSTEM:
        return AFTER_SYSTEM if state == NOTHING else None
    wanted = ASSISTANT if state == AFTER_USER else USER
    return _next(state) if initial == wanted else None


def _options(after: Costs, code: int, state: int) -> list[tuple[int, str, int]]:
    """Cost, letter and next state of each edit of a row, in the order of the letters."""
    initial, extra = code >> 2, CUT_SHORT * (code & 3 == TRUNCATED)
    found = [(DELETE + after[state], "D", state)]
    kept = _kept(state, initial)
    if kept is not None:
        found.append((KEEP + extra + after[kept], "K", kept))
    found.append((OTHER_ROLE + extra + after[_next(state)], "R", _next(state)))
    return found


def _exact(after: Costs, code: int) -> list[int]:
    return _closed([min(_options(after, code, state))[0] for state in range(4)])


LAST = tuple(_closed([0, NEVER, NEVER, 0]))  # costs after the last row


@lru_cache(maxsize=None)  # vectors differ in a few small numbers, so there are few of them
def before(after: Costs, code: int) -> Costs:
    """Costs before a row from those after it, up to a constant."""
    costs = _exact(after, code)
    least = min(costs)
    return tuple(cost - least for cost in costs)


@lru_cache(maxsize=None)
def move(after: Costs, code: int, state: int) -> tuple[str, str, int, int]:
    """The least letters of a cheapest way over one row: letters, edit, next state, cost.

    The edit has a small letter for each inserted turn, then K, D, or the initial of the
    role that the row is given.
    """
    costs, letters, edit, paid = _exact(after, code), "", "", 0
    while True:
        best = costs[state]
        ways = {letter: (cost, to) for cost, letter, to in _options(after, code, state)}
        if ways["D"][0] == best:
            return letters + "D", edit + "D", state, paid + DELETE
        if INSERT + costs[_next(state)] == best:
            letters, edit = letters + "I", edit + ("a" if state == AFTER_USER else "u")
            state, paid = _next(state), paid + INSERT
            continue
        extra = CUT_SHORT * (code & 3 == TRUNCATED)
        if "K" in ways and ways["K"][0] == best:
            return letters + "K", edit + "K", ways["K"][1], paid + KEEP + extra
        role = "A" if state == AFTER_USER else "U"
        return letters + "R", edit + role, ways["R"][1], paid + OTHER_ROLE + extra


def closing(state: int) -> str:
    """Turns inserted after the last row."""
    return {NOTHING: "", AFTER_SYSTEM: "ua", AFTER_USER: "a", AFTER_ASSISTANT: ""}[state]


def _live(rows: list[dict]) -> list[int]:
    return [row["code"] for row in rows if row["code"] & 3 < BLANK]


def backward(rows: list[dict], end: Costs) -> list[Costs]:
    """Costs after each row that may stay, and before the first at the end of the list."""
    costs = [end]
    for code in reversed(_live(rows)):
        costs.append(before(costs[-1], code))
    return costs


def forward(rows: list[dict], end: Costs, state: int) -> tuple[str, list[str], int, int]:
    """Letters, an edit for each row, the state at the end, and the cost of the edits."""
    costs = backward(rows, end)
    place, letters, edits, paid = len(costs) - 2, [], [], 0
    for row in rows:
        if row["code"] & 3 < BLANK:
            held, edit, state, cost = move(costs[place], row["code"], state)
            place -= 1
        else:
            held, edit, cost = "D", "D", DELETE
        letters.append(held + "D" * (row["n"] - 1))
        edits.append(edit)
        paid += cost + DELETE * (row["n"] - 1)
    return "".join(letters), edits, state, paid


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, h and copies."""
    held = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")),
    )
    parts = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    drawn = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(
        F.col("fault") == 2, F.translate("text", ".!?", "")
    )
    spoilt = held.withColumn("fault", drawn).filter("fault <> 0")
    return spoilt.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    ).withColumn("h", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))


def _beside(left: DataFrame, right: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right`` for its keys, of which nulls are alike."""
    other = right.withColumnsRenamed({key: f"{key}_of" for key in keys})
    same = reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"{key}_of")) for key in keys))
    return left.join(other, same, how).drop(*(f"{key}_of" for key in keys))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows that differ, in order (``at``), with how often they come and what is wrong."""
    initial = F.left("role", F.lit(1))
    number = F.when(initial == "s", SYSTEM).when(initial == "u", USER)
    number = number.when(initial == "a", ASSISTANT).otherwise(OTHER)
    final = F.regexp_extract("text", f"([^{BLANKS}])[{BLANKS}]*$", 1)
    fault = F.when(final == "", BLANK).when(final.isin(".", "!", "?"), OK).otherwise(TRUNCATED)
    counted = rows.select("conv_id", "turn", "h", "copies", number.alias("ini"), fault.alias("fault"))
    alike = materialise(
        counted.groupBy("conv_id", "turn", "h").agg(
            F.sum("copies").alias("n"), F.max("ini").alias("ini"), F.max("fault").alias("fault")
        ),
        "turns",
    )
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = alike.groupBy("conv_id", "h").agg(F.min(place).alias("least"), F.count("*").alias("m"))
    firsts = firsts.filter("m > 1").drop("m")
    joined = _beside(alike, firsts, "conv_id", "h")
    later = F.col("least").isNotNull() & (place > F.col("least"))
    told = F.when((F.col("fault") != BLANK) & later, REPEATED).otherwise(F.col("fault"))
    code = (F.col("ini") * 4 + told).cast("int").alias("code")
    judged = joined.select("conv_id", "turn", "h", "n", code)
    judged = materialise(judged, "judged")
    placed = judged.orderBy("conv_id", F.asc_nulls_first("turn"), "h")
    return materialise(placed.withColumn("at", F.monotonically_increasing_id()), "ordered")


def _mapped(
    chunks: DataFrame, told: Callable[[dict], dict], schema: str, kind: str
) -> DataFrame:
    """Each record of ``chunks`` through ``told``, which returns the changed columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):  # records hold up to a chunk of rows
                records = batch.slice(at, 200).to_pylist()
                yield pa.RecordBatch.from_pylist(
                    [record | told(record) for record in records], arrow
                )

    schema = schema.format(kind=kind)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_struct(schema))
    return chunks.mapInArrow(run, schema)


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _started(record: dict) -> dict:
    """Costs from the speculative vector, which is the true one after the last row."""
    return {"end": LAST, "first": backward(record["rows"], LAST)[-1]}


def _corrected(record: dict) -> dict:
    if not record["stale"]:
        return {}
    end = tuple(record["told"])
    return {"end": end, "first": backward(record["rows"], end)[-1]}


def _stitched(several: DataFrame, kind: str) -> DataFrame:
    """Chunks of conversations that have more than one, run until their vectors agree."""
    behind = Window.partitionBy("conv_id").orderBy("chunk")
    known = materialise(several, "vectors")
    while True:
        stale = ~F.col("last") & (F.col("told") != F.col("end"))
        told = known.withColumn("told", F.lead("first").over(behind))
        told = materialise(told.withColumn("stale", F.coalesce(stale, F.lit(False))), "told")
        if not told.filter("stale").limit(1).count():
            return known
        again = f"{VECTORS}, told array<int>, stale boolean"
        known = materialise(_mapped(told, _corrected, again, kind).drop("told", "stale"), "vectors")


def _entered(several: DataFrame, kind: str) -> DataFrame:
    """The state each chunk is entered in (conv_id, chunk, state)."""

    def exits(record: dict) -> dict:
        ends = [forward(record["rows"], tuple(record["end"]), state)[2] for state in range(4)]
        return {"exits": ends, "rows": None}

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        state, states = NOTHING, []
        for ends in table.column("exits").to_pylist():
            states.append(state)
            state = ends[state]
        return table.select(["conv_id", "chunk"]).append_column("state", pa.array(states, pa.int32()))

    left = _mapped(several, exits, f"{VECTORS}, exits array<int>", kind)
    folded = left.select("conv_id", "chunk", "exits").groupBy("conv_id")
    return folded.applyInArrow(fold, f"conv_id {kind}, chunk long, state int")


def _edited(record: dict) -> dict:
    end, state = tuple(record["end"]), record["state"]
    letters, edits, state, paid = forward(record["rows"], end, state)
    tail = closing(state) if record["last"] else ""
    rows, initials = record["rows"], [row["code"] >> 2 for row in record["rows"]]
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    pairs = zip(initials, initials[1:], strict=False)
    faults = [row["code"] & 3 for row in rows]
    copies = sum(row["n"] - 1 for row in rows)
    blanks = sum(row["n"] for row, fault in zip(rows, faults, strict=True) if fault == BLANK)
    blank_copies = blanks - faults.count(BLANK)
    return {
        "audit": letters,
        "tail": tail,
        "cost": paid + INSERT * len(tail),
        "edits": edits,
        "blank": blanks,
        "duplicate": faults.count(REPEATED) + copies - blank_copies,
        "truncated": faults.count(TRUNCATED),
        "illegal": copies + sum(pair not in legal for pair in pairs),
        "head": initials[0],
        "foot": initials[-1],
    }


EDITED = (
    f"{VECTORS}, state int, audit string, tail string, cost long, edits array<string>, blank long, "
    "duplicate long, truncated long, illegal long, head int, foot int"
)


def _edits(ordered: DataFrame, chunk_bits: int) -> DataFrame:
    """A record for each chunk with the edits of its rows."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    row = F.struct("at", "code", "n", "turn", "h")
    chunks = ordered.groupBy("conv_id", F.shiftright("at", chunk_bits).alias("chunk")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )
    live = F.exists("rows", lambda row: row["code"] % 4 < BLANK)
    chunks = materialise(chunks.withColumn("live", live), "chunks")
    behind = Window.partitionBy("conv_id").orderBy("chunk")
    after, ahead = F.lead("chunk").over(behind), F.lag("chunk").over(behind)
    linked = chunks.filter("live").drop("live").withColumns({"after": after, "ahead": ahead})
    linked = linked.withColumn("single", F.col("after").isNull() & F.col("ahead").isNull())
    linked = linked.withColumn("last", F.col("after").isNull()).drop("after", "ahead")
    known = materialise(_mapped(linked, _started, VECTORS, kind), "started")
    several = _stitched(known.filter("NOT single"), kind)
    states = materialise(_entered(several, kind), "states")
    joined = _beside(several, states, "conv_id", "chunk", how="inner")
    dead = chunks.filter("NOT live").drop("live").withColumns(
        {
            "single": F.lit(False),
            "last": F.lit(False),
            "end": F.array(*map(F.lit, LAST)),
            "first": F.array(*map(F.lit, LAST)),
        }
    )
    alone = known.filter("single").unionByName(dead).withColumn("state", F.lit(NOTHING))
    return materialise(_mapped(alone.unionByName(joined), _edited, EDITED, kind).drop("end", "first"), "edits")


def _digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation: rows and edits stream by in order."""
    each = edits.select("conv_id", F.explode(F.arrays_zip("rows", "edits")).alias("x")).select(
        "conv_id",
        F.lit(0).alias("phase"),
        F.col("x.rows.turn").alias("turn"),
        F.col("x.rows.h").alias("h"),
        F.col("x.edits").alias("edit"),
    )
    tails = edits.filter("tail <> ''").select(
        "conv_id", F.lit(1).alias("phase"), F.col("tail").alias("edit")
    )
    texts = rows.select("conv_id", F.lit(0).alias("phase"), "turn", "h", "role", "text")
    asked = each.unionByName(tails, True).unionByName(texts, True)
    order = ["conv_id", "phase", F.asc_nulls_first("turn"), "h", F.asc_nulls_last("edit")]
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = asked.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(_hashed, f"conv_id {kind}, repaired_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_id, digest, lines, due = None, None, 0, ""
    for batch in batches:
        ids, texts, kind = [], [], batch.schema.field("conv_id").type
        names = ("conv_id", "edit", "role", "text")
        for conv_id, edit, role, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if digest is None or conv_id != open_id:
                if digest is not None:
                    ids.append(open_id)
                    texts.append(digest.hexdigest())
                open_id, digest, lines, due = conv_id, hashlib.sha256(), 0, ""
            if edit is not None:
                new = [f"{ROLE_NAMES[c]}:" for c in edit if c in ROLE_NAMES]
                due = edit[-1] if edit[-1] in "KUA" else ""
            else:
                given = role if due == "K" else ROLE_NAMES.get(due.lower(), "")
                new, due = [f"{given}:{text}"] if due else [], ""
            for line in new:
                digest.update((b"\n" if lines else b"") + line.encode())
                lines += 1
        yield pa.record_batch({"conv_id": pa.array(ids, kind), "repaired_sha256": pa.array(texts, pa.string())})
    if digest is not None:
        ids, texts = pa.array([open_id], kind), pa.array([digest.hexdigest()])
        yield pa.record_batch({"conv_id": ids, "repaired_sha256": texts})


def _summary(ordered: DataFrame, edits: DataFrame) -> DataFrame:
    """Counts, cost and letters of each conversation."""
    turns = ordered.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    ahead = F.lag("foot").over(Window.partitionBy("conv_id").orderBy("chunk"))
    legal = [(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)]
    border = F.struct(F.col("ahead"), F.col("head")).isin([F.struct(F.lit(a), F.lit(b)) for a, b in legal])
    piece = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    light = edits.select("conv_id", "chunk", "audit", "tail", *sums, "head", ahead.alias("ahead"))
    wrong = (F.col("ahead").isNotNull() & ~border).cast("long")
    told = light.withColumn("illegal", F.col("illegal") + wrong).groupBy("conv_id").agg(
        *(F.sum(name).alias(name) for name in sums),
        F.array_join(F.transform(piece, lambda x: x["audit"]), "").alias("pieces"),
        F.max("tail").alias("tail"),
    )
    inserted = F.repeat(F.lit("I"), F.length("tail"))
    told = told.withColumn("audit", F.concat("pieces", inserted))
    return _beside(told, turns, "conv_id", how="inner")


def repair(conversations: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Damage ``conversations`` (conv_id, turn, role, text) and repair them; a row for each.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256.
    """
    rows = damage(conversations)
    ordered = _ordered(rows)
    edits = _edits(ordered, chunk_bits)
    told = materialise(_summary(ordered, edits), "summary")
    digests = materialise(_digests(rows, edits), "digests")
    ids = conversations.select("conv_id").distinct()
    joined = _beside(_beside(ids, told, "conv_id"), digests, "conv_id")
    zero, none = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *(F.coalesce(name, zero).alias(name) for name in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", none).alias("repaired_sha256"),
    )
