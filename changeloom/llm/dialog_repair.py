"""Conversation repair: the cheapest edits that make turns alternate, by divide and conquer over four states."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changeloom.session import work_path

BLANKS = " \t\n\v\f\r"
#: Costs of the edits, and what a truncated row adds if it stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Where a conversation stands: before its first row, after a system, a user and an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What may follow in each state, and the state it leads to.
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
SOUND, CUT, GONE = 0, 4, 8  # faults, added to the place of the initial
LEGAL = {"su", "ua", "au"}
#: Rows of a conversation that are looked at together, by the upper bits of their position.
SEGMENT_BITS = 12
FAR = 1 << 60

Step = tuple[int, int, int, object]  # from, to, cost, and what orders the steps from one state


def _inserted(state: int) -> list[tuple[int, int]]:
    """The states that up to two insertions lead to, and their number; the state itself first."""
    found = [(state, 0)]
    for _ in range(2):
        here, count = found[-1]
        following = FOLLOWS[here].get("u") or FOLLOWS[here].get("a")
        if following in [s for s, _ in found]:
            break
        found.append((following, count + 1))
    return found


def _steps(kind: int) -> list[Step]:
    """For a kind of row, the cheapest way from each state to each other, as the initials of its edits, the least of equal ones.

    Rows inserted beside a deleted one come after it, which is the lesser order, so deletions need no insertions before them.
    """
    initial, fault = "sua "[kind % 4], kind - kind % 4
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for a in STATES:
        best[a, a] = DELETE, "D"
        if fault == GONE:
            continue
        for state, count in _inserted(a):
            for letter, b in FOLLOWS[state].items():
                ways = [(0, "K")] if letter == initial else []
                ways += [(REROLE, "R")] if letter != "s" else []
                for cost, edit in ways:
                    way = cost + INSERT * count + (TRUNCATED if fault == CUT else 0), "I" * count + edit
                    best[a, b] = min(best.get((a, b), way), way)
    return [(a, b, cost, word) for (a, b), (cost, word) in best.items()]


STEPS = [_steps(kind) for kind in range(12)]
WORDS = [{(a, b): word for a, b, _, word in steps} for steps in STEPS]
#: Rows added behind the last one, by state.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def forward(items: Sequence[list[Step]], low: int, high: int, start: int) -> tuple[list[int], list[int]]:
    """The least cost of reaching each state over some items, and the order of the states by the least edits that do so.

    No such edits are the beginning of others over the same rows, so the order of a state follows from that of the state before it
    and the last step.
    """
    costs, order = [FAR] * 4, [0] * 4
    costs[start] = 0
    for i in range(low, high):
        best: list[tuple | None] = [None] * 4
        for a, b, cost, word in items[i]:
            if costs[a] < FAR:
                way = costs[a] + cost, order[a], word
                if best[b] is None or way < best[b]:
                    best[b] = way
        ranked = sorted(way[1:] for way in best if way)
        costs = [way[0] if way else FAR for way in best]
        order = [ranked.index(way[1:]) if way else 0 for way in best]
    return costs, order


def backward(items: Sequence[list[Step]], low: int, high: int, end: int) -> list[int]:
    """The least cost from each state before some items to ``end`` after them."""
    costs = [FAR] * 4
    costs[end] = 0
    for i in range(high - 1, low - 1, -1):
        before = [FAR] * 4
        for a, b, cost, _ in items[i]:
            before[a] = min(before[a], cost + costs[b])
        costs = before
    return costs


def states(items: Sequence[list[Step]], start: int, end: int) -> list[int]:
    """The state after each item on the cheapest way from ``start`` to ``end``, of equal ones that with the least edits.

    The costs from both ends meet in the middle. Of the states that cost least together, the one with the least edits before it is
    crossed; both halves are then done alike. No more than two vectors are held at a time, besides the result.
    """
    found = [end] * len(items)
    todo = [(0, len(items), start, end)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        costs, order = forward(items, low, middle, a)
        rest = backward(items, middle, high, b)
        crossed = min(STATES, key=lambda s: (costs[s] + rest[s], order[s]))
        found[middle - 1] = crossed
        todo += [(low, middle, a, crossed), (middle, high, crossed, b)]
    return found


def summary(kinds: bytes) -> list[Step]:
    """Many rows as one item: the least cost from each state to each other, and the order of the ends."""
    items = [STEPS[kind] for kind in kinds]
    found = []
    for a in STATES:
        costs, order = forward(items, 0, len(items), a)
        found += [(a, b, costs[b], order[b]) for b in STATES if costs[b] < FAR]
    return found


def crossings(items: Sequence[list[Step]]) -> tuple[int, list[int]]:
    """The least cost of a whole conversation, and the state after each of its items."""
    costs, order = forward(items, 0, len(items), START)
    total = [costs[s] + INSERT * len(TAIL[s]) for s in STATES]
    end = min(STATES, key=lambda s: (total[s], order[s]))
    return total[end], states(items, START, end)


def edits(kinds: bytes, start: int, end: int, last: bool) -> list[tuple[int, str, str | None]]:
    """The edits of some rows: the row's place, the edit's initial, and the role of inserted and changed rows."""
    found, state = [], start
    ends = states([STEPS[kind] for kind in kinds], start, end)
    for i, (kind, after) in enumerate(zip(kinds, ends, strict=True)):
        for edit in WORDS[kind][state, after]:
            if edit == "I":
                state = FOLLOWS[state].get("u") or FOLLOWS[state]["a"]
                found.append((i, edit, ROLE[state]))
            else:
                found.append((i, edit, ROLE[after] if edit == "R" else None))
        state = after
    for _ in TAIL[state] if last else "":
        state = FOLLOWS[state].get("u") or FOLLOWS[state]["a"]
        found.append((len(kinds) - 1, "I", ROLE[state]))
    return found


class Remembered(dict):
    """The results of a function for short rows of kinds, of which there are few; those of long ones are not kept."""

    def __init__(self, function, longest: int = 16, most: int = 1 << 14):
        self.function, self.longest, self.most = function, longest, most

    def of(self, kinds: bytes, *more):
        if len(kinds) > self.longest:
            return self.function(kinds, *more)
        if (kinds, *more) not in self:
            if len(self) >= self.most:
                self.clear()
            self[kinds, *more] = self.function(kinds, *more)
        return self[kinds, *more]


# Frames


def ordered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with ``conv``, ``turn``, ``role``, ``text`` and a position: conversations one after the other, each by turn, role and text.

    Null turns come first; null roles and texts are one space; null conversations are one. Rows are dealt by ranges, so a conversation of
    any length is spread over the tasks. The result is a written table.
    """
    spark = rows.sparkSession
    path = work_path(spark, "turns")
    plain = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("nth"),
    )
    by = ["conv", "turn", "role", "text", "nth"]
    placed = plain.repartitionByRange(*by).sortWithinPartitions(*by).drop("nth").withColumn("pos", F.monotonically_increasing_id())
    placed.write.parquet(path)
    return spark.read.parquet(path)


def _last() -> Column:
    return F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))


def with_faults(turns: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``pos``, ``fault`` (``blank``, ``duplicate``, ``truncated`` or null) and ``initial`` of every row of ``ordered``.

    A row is a duplicate if its role and text stand in an earlier one of its conversation (texts are compared by md5). The first of
    each text is found by a minimum, so a text that fills a conversation needs no group in memory.
    """
    last = _last()
    marked = turns.select("conv", "turn", "pos", F.left("role", F.lit(1)).alias("initial"), last.alias("last"), "role", F.md5(F.encode("text", "utf-8")).alias("same"))
    firsts = marked.groupBy("conv", "role", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("last") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    return marked.join(firsts, "pos", "left").select("conv", "turn", "pos", fault.alias("fault"), "initial")


SUMMARY = "conv_key string, segment bigint, steps array<bigint>, illegal bigint, first string, last string"
EDITS = "segment bigint, audit string, edits array<struct<pos: bigint, step: int, edit: string, role: string>>"


def _key() -> Column:
    """A conversation as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null"))


def segments(faults: DataFrame) -> DataFrame:
    """The rows of each conversation in pieces of up to 4096: ``conv_key``, ``segment``, ``first_pos``, ``kinds`` and their positions."""
    place = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    weight = F.when(F.col("fault") == "truncated", CUT).when(F.col("fault").isNotNull(), GONE).otherwise(SOUND)
    rows = faults.select(_key().alias("conv_key"), F.shiftright("pos", SEGMENT_BITS).alias("segment"), F.struct("pos", (place + weight).cast("tinyint").alias("kind")).alias("row"))
    return rows.groupBy("conv_key", "segment").agg(F.array_sort(F.collect_list("row")).alias("rows")).select("conv_key", "segment", F.col("rows.pos").alias("places"), F.col("rows.kind").alias("kinds"))


def summaries(parts: DataFrame) -> DataFrame:
    """Each piece as costs between the states, with its illegal neighbours and the initials at its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, numbers = pa.string(), pa.int64()
        known = Remembered(summary)
        schema = pa.schema([("conv_key", texts), ("segment", numbers), ("steps", pa.list_(numbers)), ("illegal", numbers), ("first", texts), ("last", texts)])
        for batch in batches:
            rows = []
            for key, segment, kinds in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                steps = [int(value) for step in known.of(bytes(kinds)) for value in step]
                letters = ["sua "[kind % 4] for kind in kinds]
                illegal = sum(a + b not in LEGAL for a, b in zip(letters, letters[1:], strict=False))
                rows.append({"conv_key": key, "segment": segment, "steps": steps, "illegal": illegal, "first": letters[0], "last": letters[-1]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return parts.select("conv_key", "segment", "kinds").mapInArrow(run, SUMMARY)


CROSSED = "conv_key string, cost bigint, illegal bigint, crossed array<struct<segment: bigint, start: int, stop: int, final: boolean>>"


def crossed(found: DataFrame) -> DataFrame:
    """For each conversation its least cost, its illegal neighbours, and the states at the ends of each of its pieces.

    What meets here is one summary for 4096 rows, so a conversation of a thousand million rows is a list of 250 000.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                items = [[tuple(p["steps"][i : i + 4]) for i in range(0, len(p["steps"]), 4)] for p in pieces]
                cost, ends = crossings(items)
                illegal = sum(p["illegal"] for p in pieces) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(pieces, pieces[1:], strict=False))
                starts = [START, *ends]
                spans = [{"segment": p["segment"], "start": a, "stop": b, "final": p is pieces[-1]} for p, a, b in zip(pieces, starts, ends, strict=False)]
                rows.append({"conv_key": key, "cost": cost, "illegal": illegal, "crossed": spans})
            span = pa.struct([("segment", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("final", pa.bool_())])
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("conv_key", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("crossed", pa.list_(span))]))

    pieces = F.array_sort(F.collect_list(F.struct("segment", "steps", "illegal", "first", "last")))
    return found.groupBy("conv_key").agg(pieces.alias("pieces")).mapInArrow(run, CROSSED)


def _planned(parts: DataFrame, ends: DataFrame) -> DataFrame:
    """The edits of each piece between its two states."""
    spans = ends.select("conv_key", F.explode("crossed").alias("span")).select("conv_key", "span.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(edits)
        one = pa.struct([("pos", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("role", pa.string())])
        schema = pa.schema([("conv_key", pa.string()), ("segment", pa.int64()), ("audit", pa.string()), ("edits", pa.list_(one))])
        for batch in batches:
            rows = []
            for key, segment, places, kinds, start, stop, final in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                done = known.of(bytes(kinds), start, stop, final)
                listed = [{"pos": places[i], "step": n, "edit": edit, "role": role} for n, (i, edit, role) in enumerate(done)]
                rows.append({"conv_key": key, "segment": segment, "audit": "".join(edit for _, edit, _ in done), "edits": listed})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    joined = parts.join(spans, ["conv_key", "segment"]).select("conv_key", "segment", "places", "kinds", "start", "stop", "final")
    return joined.mapInArrow(run, f"conv_key string, {EDITS}")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations and their repaired rows, of the table of ``ordered``.

    The first has a row for each conversation: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``. The second
    has a row for each edit: ``conv``, ``pos``, ``step`` (its order at that position), ``edit`` (K, R, D or I), ``role`` and ``text``.

    Keeping a row is free, another role costs 2, deleting 3, an inserted empty row 2, a truncated row that stays 1. Blank and
    duplicate rows are deleted. The roles left begin with at most one system row and go on with pairs of user and assistant, or
    nothing is left. Of equally cheap edits the least in ASCII order of their initials is taken.

    Long conversations are cut into pieces of up to 4096 rows. Each is summed up by its costs between the four states; the
    states at the pieces' ends are chosen as inside a piece, by costs from both sides; then every piece is done by itself. No task holds
    more than a piece, and one summary for each piece of a conversation. An empty table has no conversations.
    """
    spark = turns.sparkSession
    path = work_path(spark, "faults")
    with_faults(turns).write.parquet(path)
    faults = spark.read.parquet(path)
    path = work_path(spark, "segments")
    segments(faults).write.parquet(path)
    pieces = spark.read.parquet(path)
    path = work_path(spark, "crossed")
    crossed(summaries(pieces)).write.parquet(path)
    ends = spark.read.parquet(path)
    path = work_path(spark, "edits")
    _planned(pieces, ends).write.parquet(path)
    planned = spark.read.parquet(path)
    audits = planned.groupBy("conv_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda p: p["audit"]), "").alias("audit"))
    counted = faults.groupBy("conv").agg(
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
    )
    known = counted.withColumn("conv_key", _key()).join(ends.drop("crossed"), "conv_key").join(audits, "conv_key")
    rows = planned.select(F.explode("edits").alias("edit")).select("edit.*").withColumnRenamed("role", "new").join(turns, "pos")
    inserted = F.col("edit") == "I"
    repaired = rows.select(
        "conv", "pos", "step", "edit", F.coalesce("new", "role").alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text")
    )
    return known.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), repaired
