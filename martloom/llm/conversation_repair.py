"""Repair of conversations by the cheapest edits, with a checkpointed dynamic program.

The rows of a conversation, in order of turns, are kept, given another role or deleted, and rows
without text are inserted, until the role initials read ``(s?(ua)+)?``. Four states tell how far
that pattern is read, so the cost of finishing from any place is a vector of four numbers.

A conversation is cut into blocks of about the square root of the number of all rows. A first pass
goes through its blocks backwards and keeps the vector behind each block, the checkpoint; no other
vector is stored. A second pass goes forwards, computes the vectors inside one block again from
its checkpoint, and emits edits that cost no more than the vectors say. Both passes see one letter
for each row, not its text, and stream over sorted blocks, so a task holds one block at a time
however long a conversation is. Texts are shuffled once, when the edits are applied.

Rows of one turn are in order of role, then of their text's SHA-256. Null values count as one
space, a null conversation id is a conversation of its own, and an empty role is a role that
can't be kept. Repeated rows are duplicates from the second on. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import own
from martloom.session import write_stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States: nothing read, read a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
NEXT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: The role that a row needs in a state if it isn't a system row, and the state behind it.
WANTED = {
    START: ("user", USER),
    SYSTEM: ("user", USER),
    USER: ("assistant", ASSISTANT),
    ASSISTANT: ("user", USER),
}
LEGAL_PAIRS = {"su", "ua", "au"}

SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
#: Blocks have at least so many rows.
LEAST_BLOCK = 4096
NO_TEXT_SHA256 = hashlib.sha256().hexdigest()

Vector = tuple[int, ...]


def row_letter(fault: Column, role: Column) -> Column:
    """One letter, from A on, for a row's fault and the initial of its role."""
    initial = F.expr("0")
    for number, letter in enumerate(INITIALS, 1):
        initial = F.when(role.startswith(letter), F.lit(number)).otherwise(initial)
    return F.char(F.lit(65) + fault * 4 + initial)


#: The same letters read back: fault and initial, "-" for other roles.
LETTERS = {chr(65 + 4 * f + i): (f, ("-" + INITIALS)[i]) for f in range(4) for i in range(4)}


def with_insertions(vector: list[int]) -> Vector:
    """The costs of finishing if rows may also be inserted at this place."""
    for _ in range(3):
        vector = [min(c, INSERT + vector[WANTED[q][1]]) for q, c in enumerate(vector)]
    return tuple(vector)


AT_END = with_insertions([0, 10**6, 10**6, 0])


def moves(letter: str, state: int) -> list[tuple[str, int, int]]:
    """The edits a row can have in a state: initial, cost, state behind it. ASCII order."""
    fault, initial = LETTERS[letter]
    found = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return found
    more = TRUNCATED if fault == CUT_OFF else 0
    if (state, initial) in NEXT:
        found.append(("K", KEEP + more, NEXT[state, initial]))
    return [*found, ("R", REROLE + more, WANTED[state][1])]


class Backward(dict):
    """From a vector and a letter to the vector before that row.

    Vectors are kept less their first element. Few differ in that form, so nearly every row is
    one lookup.
    """

    def __missing__(self, key: tuple[Vector, str]) -> tuple[Vector, int]:
        vector, letter = key
        costs = [min(c + vector[to] for _, c, to in moves(letter, q)) for q in range(4)]
        self[key] = found = levelled(with_insertions(costs))
        return found


class Forward(dict):
    """From the vector behind a row, its letter and the state before it to the edits and state.

    Of the edits that finish at the vector's cost, the first in ASCII order is taken each time.
    """

    def __missing__(self, key: tuple[Vector, str, int]) -> tuple[str, int]:
        vector, letter, state = key
        (before, more), edits = BACKWARD[vector, letter], ""
        while True:
            here = before[state] + more
            ways = [(e, c + vector[to], to, True) for e, c, to in moves(letter, state)]
            to = WANTED[state][1]
            ways.append(("I", INSERT + before[to] + more, to, False))
            edit, _, state, done = min(way for way in ways if way[1] == here)
            edits += edit
            if done:
                self[key] = (edits, state)
                return self[key]


def levelled(vector: Iterable[int]) -> tuple[Vector, int]:
    first, *_ = vector = tuple(vector)
    return tuple(c - first for c in vector), first


BACKWARD, FORWARD = Backward(), Forward()


def back_through(letters: str, vector: Vector) -> Vector:
    """The vector before a block, from the one behind it."""
    level, total = levelled(vector)
    for letter in reversed(letters):
        level, more = BACKWARD[level, letter]
        total += more
    return tuple(c + total for c in level)


def walk(letters: str, vector: Vector, state: int) -> tuple[str, int]:
    """The edits of a block, from the vector behind it and the state before it; state behind."""
    level, _ = levelled(vector)
    behind = [level]
    for letter in letters[:0:-1]:
        level, _ = BACKWARD[level, letter]
        behind.append(level)
    out = []
    for letter in letters:
        edits, state = FORWARD[behind.pop(), letter, state]
        out.append(edits)
    return "".join(out), state


def last_insertions(state: int) -> str:
    """The insertions that a conversation needs at its end."""
    count = 0
    while state in (SYSTEM, USER):
        state, count = WANTED[state][1], count + 1
    return "I" * count


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))


INITIAL_OF = str.maketrans({letter: initial for letter, (_, initial) in LETTERS.items()})
FAULT_OF = str.maketrans({letter: str(fault) for letter, (fault, _) in LETTERS.items()})


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield as_batch(held, schema)
            held = []
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def schema_of(batch_type: pa.DataType, **others: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", batch_type), *others.items()])


def checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in descending order, each with the vector behind it and whether it is the last."""
    conv, vector, begun, last = None, AT_END, False, True
    for batch in batches:
        out = []
        for this, letters in zip(
            batch.column("conv").to_pylist(), batch.column("letters").to_pylist(), strict=True
        ):
            if not begun or this != conv:
                conv, vector, begun, last = this, AT_END, True, True
            out.append((list(vector), last))
            vector, last = back_through(letters, vector), False
        behind, lasts = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(behind, pa.list_(pa.int64())), pa.array(lasts)],
            names=[*batch.schema.names, "behind", "last"],
        )


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in ascending order, each with its edits, faults, illegal pairs and cost."""
    conv, state, initial, begun = None, START, "", False
    for batch in batches:
        out: list[tuple] = []
        for this, letters, behind, last in zip(
            *(batch.column(c).to_pylist() for c in ("conv", "letters", "behind", "last")),
            strict=True,
        ):
            vector, cost = tuple(behind), 0
            if not begun or this != conv:
                conv, state, initial, begun = this, START, "", True
                cost = back_through(letters, vector)[START]
            audit, state = walk(letters, vector, state)
            if last:
                audit += last_insertions(state)
            initials, faults = letters.translate(INITIAL_OF), letters.translate(FAULT_OF)
            counts = [faults.count(str(f)) for f in (BLANK, DUPLICATE, CUT_OFF)]
            out.append((audit, *counts, illegal_pairs(initial + initials), cost))
            initial = initials[-1]
        audits, *numbers = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in PLACE),
                pa.array(audits, pa.string()),
                *(pa.array(n, pa.int64()) for n in numbers),
            ],
            names=[*PLACE, "audit", *COUNTS],
        )


#: Where a block begins: its conversation, its first row's order, that row's number.
PLACE = ["conv", "turn", "role", "digest", "start"]
COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (conversation, role, text) after the edits; (conversation, None, None) after its last.

    Edits come before the first row of their block, and a conversation's rows in order.
    """
    conv, state, begun, edits = None, START, False, Edits()
    for this, role, text, audit in rows_of(batches):
        if not begun or this != conv:
            if begun:
                yield from ended(conv, state, edits)
            conv, state, begun, edits = this, START, True, Edits()
        if audit is not None:
            edits.append(iter(audit))
            continue
        while (edit := edits.next()) == "I":
            new, state = WANTED[state]
            yield conv, new, ""
        if edit == "K":
            state = NEXT[state, role[0]]
            yield conv, role, text
        elif edit == "R":
            role, state = WANTED[state]
            yield conv, role, text
    if begun:
        yield from ended(conv, state, edits)


class Edits(deque):
    """Edits of the blocks met, the initials in order."""

    def next(self) -> str:
        while self:
            for edit in self[0]:
                return edit
            self.popleft()
        return ""


def ended(conv, state: int, edits: Edits) -> Iterator[tuple]:
    while edits.next():
        role, state = WANTED[state]
        yield conv, role, ""
    yield conv, None, None


def placed(rows: Iterable[tuple]) -> Iterator[tuple]:
    place = 0
    for conv, role, text in rows:
        if role is None:
            place = 0
        else:
            yield conv, place, role, text
            place += 1


def hashed(rows: Iterable[tuple]) -> Iterator[tuple]:
    digest, begun = hashlib.sha256(), False
    for conv, role, text in rows:
        if role is None:
            yield conv, digest.hexdigest()
            digest, begun = hashlib.sha256(), False
        else:
            digest.update(f"{'\n' if begun else ''}{role}:{text}".encode())
            begun = True


def turns_of(rows: DataFrame) -> DataFrame:
    """The four columns of a conversation's rows; null roles and texts are one space."""
    space = F.lit(" ")
    return rows.select(
        own(rows, "conv_id").alias("conv"),
        own(rows, "turn").alias("turn"),
        F.coalesce(own(rows, "role"), space).alias("role"),
        F.coalesce(own(rows, "text"), space).alias("text"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """The rows of conversations with a fault in a quarter of them, drawn by id and turn."""
    turns, space = turns_of(rows), F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    text = (
        F.when(F.col("draw") == 1, F.lit(""))
        .when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        turns.withColumn("draw", F.crc32(F.encode(key, "UTF-8")) % 20)
        .where("draw <> 0")
        .select(
            F.col("conv").alias("conv_id"),
            "turn",
            F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


ORDER = ["conv", "turn", "role", "digest"]


def with_digest(turns: DataFrame) -> DataFrame:
    return turns.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))


def ordered_rows(turns: DataFrame) -> DataFrame:
    """Rows without texts, numbered in order over all conversations; written.

    Ranges are cut by order and, among equal rows, by an input row number, so neither a long
    conversation nor many equal rows make a large task.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(last == "", F.lit(BLANK))
        .when(last.isin(".", "!", "?"), F.lit(SOUND))
        .otherwise(F.lit(CUT_OFF))
    )
    small = with_digest(turns).select(
        *ORDER, fault.alias("fault"), F.monotonically_increasing_id().alias("row")
    )
    in_order = [*ORDER, "row"]
    numbered = small.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    return write_stage(
        numbered.select(*ORDER, "fault", F.monotonically_increasing_id().alias("place")), "turns"
    )


def blocks(ordered: DataFrame) -> DataFrame:
    """Blocks of rows next to each other: conversation, first row's order, letters."""
    firsts = ordered.groupBy("conv", "role", "digest").agg(F.min("place").alias("place"))
    fault = (
        F.when(F.col("fault") == BLANK, F.lit(BLANK))
        .when(F.col("first").isNull(), F.lit(DUPLICATE))
        .otherwise(F.col("fault"))
    )
    length = max(LEAST_BLOCK, math.isqrt(ordered.count()))
    return (
        ordered.join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
        .withColumn("letter", row_letter(fault, F.col("role")))
        .groupBy("conv", F.expr(f"place div {length}").alias("block"))
        .agg(
            F.min("place").alias("start"),
            F.min_by(F.struct("turn", "role", "digest"), "place").alias("at"),
            F.sort_array(F.collect_list(F.struct("place", "letter"))).alias("letters"),
        )
        .select(
            "conv",
            "at.turn",
            "at.role",
            "at.digest",
            "start",
            F.array_join("letters.letter", "").alias("letters"),
        )
    )


def dealt(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *order)


def block_edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``repair`` in order, without texts, and the edits of each block; written."""
    ordered = ordered_rows(turns_of(rows))
    cut = blocks(ordered)
    kind = {f.name: f.dataType.simpleString() for f in cut.schema}
    fields = ", ".join(f"{c} {kind[c]}" for c in PLACE)
    behind = dealt(cut, F.desc("start")).mapInArrow(
        checkpoints, f"{fields}, letters string, behind array<bigint>, last boolean"
    )
    counts = ", ".join(f"{c} long" for c in COUNTS)
    edits = dealt(behind, "start").mapInArrow(edited, f"{fields}, audit string, {counts}")
    return ordered, write_stage(edits, "edits")


def edits_and_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits and rows dealt by conversation and sorted, edits before the rows they are for."""
    texts = with_digest(turns_of(rows)).withColumn("kind", F.lit(1))
    before = edits.select(*PLACE, "audit", F.lit(0).alias("kind"))
    both = before.unionByName(texts, allowMissingColumns=True)
    order = ["turn", "role", "digest", "kind", "start"]
    return dealt(both, *order).select("conv", "role", "text", "audit")


def arrow_type(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType, Iterator[pa.RecordBatch]]:
    first = next(batches, None)
    if first is None:
        return pa.int64(), iter(())

    def all_of():
        yield first
        yield from batches

    return first.schema.field("conv").type, all_of()


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id``, ``place`` from 0, ``role``, ``text``."""

    def apply(batches):
        kind, batches = arrow_type(iter(batches))
        schema = schema_of(kind, place=pa.int64(), role=pa.string(), text=pa.string())
        return batched(placed(repaired(batches)), schema)

    _, edits = block_edits(rows)
    conv = edits.schema["conv"].dataType.simpleString()
    return (
        edits_and_rows(rows, edits)
        .mapInArrow(apply, f"conv {conv}, place long, role string, text string")
        .withColumnRenamed("conv", "conv_id")
    )


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired ``role:text`` lines.

    The hash runs through a conversation in order, so its rows pass one task, one at a time.
    """

    def apply(batches):
        kind, batches = arrow_type(iter(batches))
        return batched(hashed(repaired(batches)), schema_of(kind, repaired_sha256=pa.string()))

    conv = edits.schema["conv"].dataType.simpleString()
    return edits_and_rows(rows, edits).mapInArrow(apply, f"conv {conv}, repaired_sha256 string")


def repair_report(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """One row for each conversation of ``originals``: faults, cost, edits, digest of the repair.

    ``originals`` may have conversations of which ``rows`` has nothing left; these have zeros, no
    edits and the digest of an empty text.
    """
    ordered, edits = block_edits(rows)
    turns = ordered.groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long").alias("gaps")
    )
    audit = F.array_join(
        F.sort_array(F.collect_list(F.struct("start", "audit")))["audit"],
        "",
    )
    sums = [F.sum(c).alias(c) for c in COUNTS]
    audits = edits.groupBy("conv").agg(audit.alias("audit"), *sums)
    parts = originals.select(own(originals, "conv_id").alias("conv")).distinct()
    for part in (gaps, audits, repaired_digests(rows, edits)):
        parts = parts.unionByName(part, allowMissingColumns=True)
    zero = F.lit(0).cast("long")
    return parts.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), zero).alias(c) for c in ("gaps", *COUNTS)],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(NO_TEXT_SHA256)).alias("repaired_sha256"),
    )


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")
