"""Repair of the turn structure of conversations at least cost, ties by the least audit.

Rows of a conversation are kept, given another role or deleted, and empty rows are inserted, so that the initials of the
roles read `(s?(ua)+)?`. What is decided is a path through a small graph: its nodes are (rows done, what the last
initial was), an edge edits one row and may insert up to two rows before it.

The weight of an edge is one integer. Its high digits are the cost; below stand three digits for every row, in which the
edge writes its letters in order, zeros after them. As no edit of a row is the beginning of another, comparing such
digits is comparing audits, so the integer minimum over paths is the least cost and, among those, the ASCII-least audit.

Long conversations are cut into segments of at most 256 rows. A segment gives its best path for each pair of states at
its ends; a second pass, over a few small integers per segment, chooses among them. So neither the integers nor the rows
held by a task grow with a conversation. Texts are read twice: once for their faults and hashes, once in order for the
digest of the repaired conversation, which is a running SHA-256.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.streams import batches_of, rows_of, walk_sorted
from gapweave.storage import materialize

START, S, U, A = range(4)
STATES = (START, S, U, A)
#: What an inserted or renamed row leads to.
_NEXT = {START: U, S: U, U: A, A: U}
_ROLE = {U: "user", A: "assistant"}
#: Digits of the letters; zero is the padding. They stand in ASCII order.
LETTERS = "0DIKR"
_DIGIT_BITS, _FIELD_BITS = 3, 9
SEGMENT_ROWS = 256
#: A row's code: initial s, u, a or another, times clean, truncated, or to be deleted.
INITIALS = "sua"
CODES = "abcdefghijkl"
#: Letters that end a conversation left in a state, and their cost.
_TAIL = {START: "", A: "", U: "I", S: "II"}
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _digits(letters: str) -> int:
    """Three digits of a row's letters, zeros after them."""
    value = 0
    for letter in letters.ljust(3, "0"):
        value = value << _DIGIT_BITS | LETTERS.index(letter)
    return value


@lru_cache(maxsize=None)
def edges(code: str, state: int) -> tuple[tuple[int, int, int], ...]:
    """(next state, cost, digits) of all ways to edit one row of this code after this state."""
    kind, fault = divmod(CODES.index(code), 3)
    found = []
    for inserts in range(3):
        ways = [("D", 3, state)]
        if fault < 2:
            ways.append(("R", 2 + fault, _NEXT[state]))
            if (kind == S - 1 and state == START and not inserts) or (kind == U - 1 and state != U) or (kind == A - 1 and state == U):
                ways.append(("K", fault, (S, U, A)[kind]))
        found += [(to, 2 * inserts + cost, _digits("I" * inserts + letter)) for letter, cost, to in ways]
        state = _NEXT[state]
    return tuple(found)


@lru_cache(maxsize=1 << 14)
def best_paths(codes: str) -> tuple[tuple[int, int] | None, ...]:
    """(cost, digits) of the best path over the rows, for each of the 16 pairs of states before and after."""
    n = len(codes)
    cost_at = n * _FIELD_BITS
    result: list[tuple[int, int] | None] = []
    for begin in STATES:
        weights: list[int | None] = [0 if state == begin else None for state in STATES]
        for place, code in enumerate(codes):
            shift = (n - 1 - place) * _FIELD_BITS
            after: list[int | None] = [None] * 4
            for state in STATES:
                before = weights[state]
                if before is None:
                    continue
                for to, cost, digits in edges(code, state):
                    weight = before + (cost << cost_at) + (digits << shift)
                    if after[to] is None or weight < after[to]:
                        after[to] = weight
            weights = after
        result += [None if w is None else (w >> cost_at, w & ((1 << cost_at) - 1)) for w in weights]
    return tuple(result)


def letters_of(digits: int) -> str:
    """The letters of a path, without padding."""
    found = []
    while digits:
        if digit := digits & 7:
            found.append(LETTERS[digit])
        digits >>= _DIGIT_BITS
    return "".join(reversed(found))


def _segment_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (at, codes): costs, ranks of the digits and audits of the 16 best paths of a segment."""

    def rows() -> Iterator[tuple]:
        for at, codes in rows_of(batches):
            paths = best_paths(codes)
            ranked = {d: rank for rank, d in enumerate(sorted({path[1] for path in paths if path}))}
            yield (
                at,
                [path[0] if path else -1 for path in paths],
                [ranked[path[1]] if path else -1 for path in paths],
                [letters_of(path[1]) if path else None for path in paths],
            )

    return batches_of(rows(), _PATHS)


_PATHS = pa.schema([
    ("at", pa.int64()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
])
_PATHS_DDL = "at bigint, costs array<bigint>, ranks array<int>, audits array<string>"


def _choose(segments: list[tuple]) -> Iterator[tuple]:
    """(at, pick, tail, cost) of the segments of one conversation, given last first as (at, costs, ranks)."""
    tails = sorted(set(_TAIL.values()))
    best = [(2 * len(_TAIL[state]), tails.index(_TAIL[state])) for state in STATES]
    picks = []
    for _, costs, ranks in segments:
        found = []
        for begin in STATES:
            ways = [
                (costs[i] + best[end][0], ranks[i], best[end][1], i)
                for end in STATES
                if costs[i := 4 * begin + end] >= 0
            ]
            found.append(min(ways))
        order = sorted({way[1:3] for way in found})
        best = [(way[0], order.index(way[1:3])) for way in found]
        picks.append(bytes(way[3] for way in found))
    state = START
    for k in range(len(segments) - 1, -1, -1):
        pick = picks[k][state]
        state = pick % 4
        tail = _TAIL[state] if k == 0 else ""
        yield segments[k][0], pick, tail, segments[k][1][pick] + 2 * len(tail)


def _choose_all(rows: Iterator[tuple]) -> Iterator[tuple]:
    """`_choose` over the conversations of sorted rows (conv_id, at, costs, ranks)."""
    conv, held = None, []
    for conv_id, at, costs, ranks in rows:
        if held and conv_id != conv:
            yield from _choose(held)
            held = []
        conv = conv_id
        held.append((at, costs, ranks))
    if held:
        yield from _choose(held)


_PICKS = pa.schema([("at", pa.int64()), ("pick", pa.int32()), ("tail", pa.string()), ("cost", pa.int64())])


class _Repaired:
    """Running result of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.cost, self.state, self.first = conv_id, 0, START, True
        self.letters: deque[str] = deque()
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + role.encode() + b":" + text.encode())
        self.first = False

    def inserted(self) -> None:
        while self.letters and self.letters[0] == "I":
            self.letters.popleft()
            self.state = _NEXT[self.state]
            self.line(_ROLE[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.letters.popleft()
        if letter == "R":
            self.state = _NEXT[self.state]
            self.line(_ROLE[self.state], text)
        elif letter == "K":
            self.state = (S, U, A)[INITIALS.index(role[0])]
            self.line(role, text)

    def result(self) -> tuple:
        self.inserted()
        return self.conv_id, self.cost, "".join(self.audit), self.digest.hexdigest()


def _apply(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Results of conversations from sorted rows; the letters of a segment (kind 0) come before its rows (kind 1)."""
    current = None
    for conv_id, _, role, _, kind, _, text, cost in rows:
        if current is None or conv_id != current.conv_id:
            if current is not None:
                yield current.result()
            current = _Repaired(conv_id)
        if kind == 0:
            current.letters.extend(text)
            current.audit.append(text)
            current.cost += cost
        else:
            current.row(role, text)
    if current is not None:
        yield current.result()


_RESULT = pa.schema([
    ("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
_RESULT_DDL = "conv_id bigint, cost bigint, audit string, repaired_sha256 string"


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a fault in about a quarter of the rows, by CRC-32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its `.`, `!` and `?`, 3 repeats it, 4 makes it a user's. Nulls of
    conv_id and turn are one space there; null roles and texts become one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), fault.alias("fault"))
        .where("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "")
            .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def _faults(rows: DataFrame) -> DataFrame:
    """(at, conv_id, turn, role, digest, blank, duplicate, truncated, code): `at` grows in the order of the rows."""
    facts = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ranged = facts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")
    first = ranged.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(False).alias("again"))
    kind = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    kind = F.when(F.col("role") == "", 3).otherwise(kind)
    return (
        ranged.join(first, "at", "left")
        .withColumn("duplicate", F.coalesce("again", F.lit(True)) & ~F.col("blank"))
        .withColumn("truncated", F.col("truncated") & ~F.col("blank") & ~F.col("duplicate"))
        .withColumn("state", F.when(F.col("blank") | F.col("duplicate"), 2).when(F.col("truncated"), 1).otherwise(0))
        .withColumn("code", F.substring(F.lit(CODES), kind * 3 + F.col("state") + 1, F.lit(1)))
        .drop("again", "state")
    )


def _segments(faults: DataFrame) -> DataFrame:
    """(conv_id, at, turn, role, digest, codes): at most 256 rows of one conversation, named by their first row."""
    place = F.struct("at", "code")
    return (
        # The low 33 bits of `at` count the rows of a partition.
        faults.groupBy("conv_id", F.shiftright("at", SEGMENT_ROWS.bit_length() - 1).alias("segment"))
        .agg(
            F.min("at").alias("at"),
            F.min_by(F.struct("turn", "role", "digest"), "at").alias("first"),
            F.array_join(F.transform(F.sort_array(F.collect_list(place)), lambda p: p["code"]), "").alias("codes"),
        )
        .select("conv_id", "at", "first.*", "codes")
    )


def illegal_pairs(segments: DataFrame) -> DataFrame:
    """(conv_id, illegal): neighbours whose initials are not su, ua or au. Segments are counted apart, then their seams."""
    by_three = "translate(codes, 'abcdefghijkl', 'sssuuuaaaxxx')"
    runs = segments.select("conv_id", "at", F.expr(by_three).alias("run"))
    legal = F.array(*map(F.lit, ("su", "ua", "au")))

    def wrong(run):
        pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: run.substr(i, F.lit(2)))
        return F.when(F.length(run) < 2, 0).otherwise(F.size(F.filter(pairs, lambda p: ~F.array_contains(legal, p))))

    def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, total, last = None, None, ""
        for conv_id, _, count, ends in rows:
            if total is None or conv_id != conv:
                if total is not None:
                    yield conv, total
                conv, total, last = conv_id, 0, ""
            total += count + (bool(last) and last + ends[0] not in ("su", "ua", "au"))
            last = ends[-1]
        if total is not None:
            yield conv, total

    run = F.col("run")
    seams = runs.select("conv_id", "at", wrong(run).cast("bigint"), F.concat(run.substr(1, 1), F.right(run, F.lit(1))))
    out = pa.schema([("conv_id", pa.int64()), ("illegal", pa.int64())])
    return walk_sorted(seams, "conv_id", [F.col("at")], walk, out, "conv_id bigint, illegal bigint")


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation in `rows`.

    `rows` has conv_id, turn, role and text without null roles and texts; other columns are ignored. Rows go by turn
    (nulls first), role and SHA-256 of their text. A null conv_id is a conversation like any other. A role that begins
    with neither s, u nor a, or is empty, cannot be kept. No rows, no result.
    """
    faults = materialize(_faults(rows), "faults")
    segments = materialize(_segments(faults), "segments")
    paths = materialize(segments.select("at", "codes").mapInArrow(_segment_paths, _PATHS_DDL), "paths")
    chain = segments.select("conv_id", "at").join(paths.select("at", "costs", "ranks"), "at").select("conv_id", "at", "costs", "ranks")
    picks = walk_sorted(
        chain, "conv_id", [F.col("at").desc()], _choose_all, _PICKS, "at bigint, pick int, tail string, cost bigint"
    )
    decided = (
        segments.drop("codes").join(picks, "at").join(paths.select("at", "audits"), "at")
        .select(
            "conv_id", "turn", "role", "digest", F.lit(0).alias("kind"), "at",
            F.concat(F.get("audits", F.col("pick")), F.col("tail")).alias("text"), "cost",
        )
    )
    texts = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(1).alias("kind"),
        F.lit(0).cast("bigint").alias("at"), "text", F.lit(0).cast("bigint").alias("cost"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("kind"), F.col("at")]
    repaired = walk_sorted(decided.unionByName(texts), "conv_id", order, _apply, _RESULT, _RESULT_DDL)

    def count(flag: str):
        return F.sum(F.col(flag).cast("bigint")).alias(flag)

    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = faults.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), count("blank"), count("duplicate"), count("truncated")
    )
    result = counts
    for part in (illegal_pairs(segments), repaired):
        named = part.withColumnRenamed("conv_id", "other")
        result = result.join(named, F.col("conv_id").eqNullSafe(F.col("other"))).drop("other")
    return result


def repair_damaged(turns: DataFrame) -> DataFrame:
    """`repair` of the rows that `damage` leaves, with a row for every original conv_id.

    Conversations of which nothing is left have zeros, an empty audit and the digest of the empty text. An empty table
    gives no rows.
    """
    found = repair(damage(turns)).withColumnRenamed("conv_id", "other")
    every = turns.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("other")), "left").select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(_EMPTY_SHA)).alias("repaired_sha256"),
    )
