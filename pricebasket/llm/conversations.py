"""Repair of conversation structure by the cheapest edits, found with Hirschberg's divide and conquer.

A conversation should go: at most one system row, then user and assistant in turn, at least once, or be
empty. The role initials fit ``(s?(ua)+)?``, an automaton of four states. Each row is kept, given another
role or deleted, and empty rows may be put in. Costs of paths are vectors over the four states. A
conversation is halved; a forward vector over the first half and a backward vector over the second meet
in the middle, the crossing state is chosen, and both halves go on by themselves. So a byte a row is all that is held.

Of equally cheap edits those with the least audit (their initials as ASCII text) count. Audits that lead
over the same rows, each up to its last row, are never one the beginning of the other, and from one state
an audit leads to one state only; so a forward vector also ranks its states' least audits, and the crossing
of least rank among the cheapest is the right one, without any audit being held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pricebasket.llm.batches import released
from pricebasket.session import stage

#: Cost of each edit; a truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant; the first and the last may end.
KEEPS = {0: {0: 1, 1: 2}, 1: {1: 2}, 2: {2: 3}, 3: {1: 2}}
#: The one state that an inserted row, or one of a new role, leads to.
FORCED = (2, 2, 3, 2)
#: Edits after the last row.
CLOSING = ("", "II", "I", "")
ROLES = {2: "user", 3: "assistant"}
FAR = 1 << 60
#: A row's kind is 3 * initial (system, user, assistant, other) + fault.
INITIALS = "sua"
SOUND, GONE, CUT = 0, 1, 2
#: Marks a further copy of the row before; never part of a repaired conversation.
COPY = 128 | 3 * 3 + GONE
#: Segments up to this many rows are remembered by their kinds.
SHORT = 24


@lru_cache(maxsize=None)
def _steps(kind: int) -> tuple[dict[int, tuple[int, str]], ...]:
    """For each state, the cheapest (then least) edits that use up a row of this kind, by the state they lead to."""
    initial, fault = divmod(kind & 127, 3)
    found = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        for inserts in range(3):
            ways = [(state, DELETE, "D")]
            if fault != GONE:
                more = TRUNCATED if fault == CUT else 0
                ways.append((FORCED[state], REROLE + more, "R"))
                if initial in KEEPS[state]:
                    ways.append((KEEPS[state][initial], more, "K"))
            for to, cost, edit in ways:
                best[to] = min(best.get(to, (FAR, "")), (inserts * INSERT + cost, "I" * inserts + edit))
            state = FORCED[state]
        found.append(best)
    return tuple(found)


@lru_cache(maxsize=1 << 16)
def _ahead(vector: tuple, kind: int) -> tuple[tuple, int]:
    """A forward vector, (cost, rank of the least audit) by state, led over one row; costs start at 0 again."""
    best: dict[int, tuple[int, int, str]] = {}
    for state, (cost, rank) in enumerate(vector):
        if cost < FAR:
            for to, (more, edits) in _steps(kind)[state].items():
                best[to] = min(best.get(to, (FAR, 0, "")), (cost + more, rank, edits))
    least = min(way[0] for way in best.values())
    order = sorted(best, key=lambda to: best[to][1:])
    return tuple((best[to][0] - least, order.index(to)) if to in best else (FAR, 0) for to in range(4)), least


@lru_cache(maxsize=1 << 16)
def _back(vector: tuple, kind: int) -> tuple:
    """A backward vector, the cost from each state to the end, led over one row; costs start at 0 again."""
    costs = [min((more + vector[to] for to, (more, _) in _steps(kind)[state].items()), default=FAR) for state in range(4)]
    least = min(costs)
    return tuple(min(cost - least, FAR) for cost in costs)


def _forward(kinds: bytes, low: int, high: int, start: int) -> tuple[tuple, int]:
    vector, cost = tuple((0, 0) if state == start else (FAR, 0) for state in range(4)), 0
    for kind in memoryview(kinds)[low:high]:
        vector, more = _ahead(vector, kind)
        cost += more
    return vector, cost


def _backward(kinds: bytes, low: int, high: int, end: int) -> tuple:
    vector = tuple(0 if state == end else FAR for state in range(4))
    for kind in reversed(memoryview(kinds)[low:high]):
        vector = _back(vector, kind)
    return vector


def _edits(kinds: bytes, low: int, high: int, start: int, end: int) -> Iterator[str]:
    """For each row, its edits (inserted rows before it first) on the least of the cheapest ways from start to end."""
    if high - low <= SHORT:
        yield from _short(kinds[low:high], start, end)
        return
    middle = (low + high) // 2
    here = _crossing(_forward(kinds, low, middle, start)[0], _backward(kinds, middle, high, end))
    yield from _edits(kinds, low, middle, start, here)
    yield from _edits(kinds, middle, high, here, end)


@lru_cache(maxsize=1 << 16)
def _short(kinds: bytes, start: int, end: int) -> tuple[str, ...]:
    if len(kinds) == 1:
        return (_steps(kinds[0])[start][end][1],)
    middle = len(kinds) // 2
    here = _crossing(_forward(kinds, 0, middle, start)[0], _backward(kinds, middle, len(kinds), end))
    return _short(kinds[:middle], start, here) + _short(kinds[middle:], here, end)


def _crossing(ahead: tuple, behind: tuple | list) -> int:
    return min((ahead[state][0] + behind[state], ahead[state][1], state) for state in range(4))[2]


def audit(kinds: bytes) -> tuple[int, str, str]:
    """Cost and least audit of a conversation, and the audit without the edits of further copies."""
    if not kinds:
        return 0, "", ""
    vector, cost = _forward(kinds, 0, len(kinds), 0)
    end = _crossing(vector, [INSERT * len(edits) for edits in CLOSING])
    cost += vector[end][0] + INSERT * len(CLOSING[end])
    edits = list(_edits(kinds, 0, len(kinds), 0, end))
    return cost, "".join(edits) + CLOSING[end], "".join(e for e, kind in zip(edits, kinds) if kind != COPY) + CLOSING[end]


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` after the damage that each row's crc32(`conv_id:turn`) % 20 names.

    A null is one blank, in that key and as role or text; turn and conv_id themselves stay null. Dropped rows stay with 0 copies
    and no text, so that a conversation that loses all of its rows is still there.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")))
    case = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    return rows.select("conv_id", "turn", "role", "text", case.alias("case")).select(
        "conv_id", "turn",
        F.when(F.col("case") == 0, "").when(F.col("case") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("case") <= 1, "").when(F.col("case") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(F.col("case") == 0, 0).when(F.col("case") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    text_key = F.unhex(F.sha2(F.col("text"), 256))
    return rows.select("conv_id", "turn", "role", text_key.alias("text_key"), "text", "copies")


def _kinds(rows: DataFrame) -> DataFrame:
    """A row per distinct (conv_id, turn, role, text), its copies, initial and first fault; no texts.

    Equal rows are summed before they are dealt, and so is the search for a text's first place, so a
    conversation or a copy that holds a large share of all rows is spread over the tasks.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    each = stage(
        _keyed(rows).select("*", last.alias("last")).groupBy("conv_id", "turn", "role", "text_key", "last").agg(F.sum("copies").alias("copies")),
        "turns")
    there = each.filter((F.col("copies") > 0) & (F.col("last") != ""))
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    repeated = there.groupBy("conv_id", "role", "text_key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("places")).filter("places > 1")
    known = repeated.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text_key").alias("_key"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text_key") == F.col("_key"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("last") == "", "blank").when(later, "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    return each.join(known, same, "left").select(
        "conv_id", "turn", "role", "text_key", "copies", fault.alias("fault"),
        F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1).alias("initial"))


SLICE = ("turn long, role string, text_key binary, kinds binary, blank long, duplicate long, truncated long, "
         "illegal long, first int, last int, first_turn long, last_turn long, turns long")
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _sliced(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each run of rows of one conversation as one row: a byte for each of its rows, and counts."""
    made: list[dict] = []
    run: dict | None = None
    codes = {"": SOUND, "blank": GONE, "duplicate": GONE, "truncated": CUT}
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text_key", "copies", "fault", "initial"))):
            conv, turn, role, text_key, copies, fault, initial = row
            if run is None or conv != run["conv_id"]:
                if run is not None:
                    made.append(run)
                if len(made) >= 4096:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made = []
                run = dict(conv_id=conv, turn=turn, role=role, text_key=text_key, kinds=bytearray(), blank=0, duplicate=0, truncated=0,
                           illegal=0, first=None, last=None, first_turn=None, last_turn=None, turns=0)
            if not copies:
                continue
            run["kinds"].append(3 * initial + codes[fault])
            run["kinds"].extend(bytes([COPY]) * (copies - 1))
            run["blank"] += copies if fault == "blank" else 0
            run["duplicate"] += copies if fault == "duplicate" else copies - 1 if fault != "blank" else 0
            run["truncated"] += fault == "truncated"
            run["illegal"] += copies - 1 + (run["last"] is not None and (run["last"], initial) not in LEGAL)
            run["first"] = initial if run["first"] is None else run["first"]
            run["last"] = initial
            if turn is not None:
                run["turns"] += turn != run["last_turn"]
                run["first_turn"] = turn if run["first_turn"] is None else run["first_turn"]
                run["last_turn"] = turn
    if run is not None:
        made.append(run)
    if made:
        yield pa.RecordBatch.from_pylist(made, schema)


def _together(slices: list[dict]) -> dict:
    """The counts and the audit of a conversation from its slices, in order."""
    found = {name: sum(each[name] for each in slices) for name in ("blank", "duplicate", "truncated", "illegal")}
    held = [each for each in slices if each["first"] is not None]
    found["illegal"] += sum((a["last"], b["first"]) not in LEGAL for a, b in zip(held, held[1:]))
    dated = [each for each in slices if each["first_turn"] is not None]
    turns = sum(each["turns"] for each in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
    found["gaps"] = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - turns if dated else 0
    found["cost"], found["audit"], found["plan"] = audit(b"".join(each["kinds"] for each in slices))
    return found


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """A row per conversation of ``rows`` (conv_id, turn, role, text, copies): its counts, cost, audit and plan.

    Rows are sorted over all tasks by (conv_id, turn, role, text's hash), nulls first, so a long conversation lies in several of
    them; each makes one slice of what it has of a conversation, a byte a row. A conversation's
    slices come together in one row, as its audit must. ``plan`` is the audit without further copies.
    """
    kinds = stage(_kinds(rows), "kinds")
    order = ["conv_id", "turn", "role", "text_key"]
    whole = T.StructType([kinds.schema["conv_id"], *T._parse_datatype_string(SLICE)])
    arrow = to_arrow_schema(whole)
    slices = kinds.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        released(lambda parts: _sliced(parts, arrow)), whole)
    key = F.struct(F.col("turn").isNotNull().alias("has"), *(F.col(name) for name in T._parse_datatype_string(SLICE).names))
    gathered = slices.groupBy("conv_id").agg(F.sort_array(F.collect_list(key)).alias("slices"))
    out = T.StructType([kinds.schema["conv_id"], *T._parse_datatype_string(f"{COUNTS}, plan string")])
    result = to_arrow_schema(out)

    def solve(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            solved = [{"conv_id": conv, **_together(each)} for conv, each in zip(batch.column("conv_id").to_pylist(), batch.column("slices").to_pylist())]
            yield pa.RecordBatch.from_pylist(solved, result)

    return stage(gathered.mapInArrow(released(solve), out), "audits")


def _edited(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Every conversation's audit row, then its distinct rows in order, in one task each.

    Texts travel twice: once to the sum of equal rows, once to their conversation.
    """
    single = _keyed(rows).filter("copies > 0").groupBy("conv_id", "turn", "role", "text_key").agg(F.max("text").alias("text"))
    turns = single.select("conv_id", F.lit(1).alias("part"), "turn", "role", "text_key", "text", F.lit(None).cast("string").alias("plan"))
    none = [F.lit(None).cast(single.schema[name].dataType).alias(name) for name in ("turn", "role", "text_key", "text")]
    return turns.unionByName(solved.select("conv_id", F.lit(0).alias("part"), *none, "plan")).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "turn", "role", "text_key")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Goes through conversations' rows once: (conv_id, None) at each one's start, then (conv_id, (turn, role, text)) for every repaired row."""
    plan, at, state, conv = "", 0, 0, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while plan[at : at + 1] == "I":
            at, state = at + 1, FORCED[state]
            yield conv, (None, ROLES[state], "")

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "part", "turn", "role", "text", "plan"))):
            if row[1] == 0:
                yield from inserted()
                (conv, _, _, _, _, plan), at, state = row, 0, 0
                yield conv, None
                continue
            yield from inserted()
            edit, at = plan[at], at + 1
            if edit == "R":
                state = FORCED[state]
                yield conv, (row[2], ROLES[state], row[4])
            elif edit == "K":
                state = KEEPS[state][INITIALS.index(row[3][0])]
                yield conv, (row[2], row[3], row[4])
    yield from inserted()


def _mapped(rows: DataFrame, make, schema: str) -> DataFrame:
    out = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string(schema)])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for each in make(_walk(batches)):
            held.append(each)
            size += 64 + len(each.get("text") or "")
            if size >= 1 << 20:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    return rows.mapInArrow(released(run), out)


def _digests(walk: Iterator[tuple]) -> Iterator[dict]:
    conv, digest, begun = None, None, False
    for here, row in walk:
        if row is None:
            if digest is not None:
                yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}
            conv, digest, begun = here, hashlib.sha256(), False
        else:
            digest.update((b"\n" if begun else b"") + f"{row[1]}:{row[2]}".encode())
            begun = True
    if digest is not None:
        yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}


def _listed(walk: Iterator[tuple]) -> Iterator[dict]:
    position = 0
    for conv, row in walk:
        position = 0 if row is None else position + 1
        if row is not None:
            yield {"conv_id": conv, "position": position - 1, "turn": row[0], "role": row[1], "text": row[2]}


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, position (from 0), turn (null where put in), role, text.

    ``rows`` as from ``damaged``; rows given as they are need ``copies`` 1.
    """
    return _mapped(_edited(rows, audits(rows)), _listed, "position long, turn long, role string, text string")


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation.

    ``rows``: conv_id, turn, role, text, copies, as from ``damaged``; further columns are not looked at. Rows
    of one turn lie by role, then by the SHA-256 of their text. A null conv_id is a conversation of its own, null turns
    come first and are no gap, an empty role has no initial. A conversation without rows has zeros,
    an empty audit and the hash of an empty text; an empty table gives no row. A digest runs through its conversation's text, row by
    row in one task, as SHA-256 does; no more than a row and the audit are held.
    """
    solved = audits(rows)
    digests = _mapped(_edited(rows, solved), _digests, "repaired_sha256 string")
    renamed = digests.withColumnRenamed("conv_id", "_conv")
    return solved.join(renamed, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
