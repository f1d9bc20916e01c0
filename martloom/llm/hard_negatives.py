"""Hard negatives: for an anchor and each of its positives, the best rows of other labels whose
score lies in a window below the positive's.

The windows of an anchor's positives overlap. Their upper limits cut the scores into disjoint
slots, highest window last: a row of another label belongs to the slot of the smallest upper limit
that it doesn't pass. Each task keeps the best ``k`` rows of every slot, and so does the merge. The
slots in descending order, from a positive's own on, hold the best ``k`` of its window first; what
is under its lower limit is cut off the end. So one pass over the rows answers all windows.

Anchors are taken in waves of bounded size, which are broadcast; the rows are read in place, block
by block, and never shuffled. Before a pass, a part of the rows drawn by hash gives for each slot
a score that the ``k``-th best row has at least. Tasks send on only rows that reach it, so what
is merged hardly grows with the number of tasks; nothing that could be in the result is lost.

Scores are exact: blocks whose products may pass the range of exact doubles are multiplied as
integers of any length, and a score that is no 64-bit integer raises. A shorter vector counts as
filled up with zeros. Rows with a null label, vector or component, or a component that isn't
finite, take no part. Rows with an anchor's id are neither its positives nor its negatives, and
equal anchor rows are one anchor; other repeated rows count each. A null id is no anchor and comes
after other ids. An empty table gives no rows, and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import own
from martloom.session import write_stage

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
#: Bytes of anchor vectors, as doubles, in a wave, and the most anchors.
WAVE_BYTES, WAVE_ANCHORS = 16 << 20, 16384
#: One row in so many is looked at before a pass.
PILOT = 32
#: Scores computed at once.
TILE = 1 << 21
EXACT = 1 << 53
NOTHING = -(1 << 63)
LAST_ID = (1 << 63) - 1


@dataclass
class Wave:
    """Some anchors, and what a pass looks for.

    ``slots`` gives for each anchor the lowest and highest score of its slots, in ascending order;
    slots that an anchor doesn't have begin above their end.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    same_label: bool
    slots: np.ndarray
    floors: np.ndarray
    k: int


def integer_vectors(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``floor(256 * x)``, of ``width`` or more numbers; objects where doubles don't do."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(float))
    width = max(width, int(lengths.max(initial=0)))
    inside = np.arange(width) < lengths[:, None]
    out = np.zeros((len(column), width))
    out[inside] = values
    return out


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of both, as 64-bit integers."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    largest = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    if max(width, 1) * max(largest[0], 1) * max(largest[1], 1) < EXACT:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (left, right)]
    found = whole[0].reshape(len(left), width) @ whole[1].reshape(len(right), width).T
    return found.astype(object).astype(np.int64)


class Best:
    """The best ``k`` rows of each slot of a wave's anchors, as met so far."""

    def __init__(self, wave: Wave):
        self.wave, self.held = wave, []
        self.floors = wave.floors.copy()
        self.waiting, self.room = 0, 4 * wave.floors.size * wave.k + 10_000

    def add(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("vec_id").fill_null(LAST_ID).to_numpy()
        labels = batch.column("label").to_numpy()
        vectors = integer_vectors(batch.column("embedding"), self.wave.vectors.shape[1])
        step = max(1, TILE // max(1, len(ids)))
        for begin in range(0, len(self.wave.ids), step):
            part = slice(begin, begin + step)
            scores = product(self.wave.vectors[part], vectors)
            other = self.wave.ids[part, None] != ids
            other &= (self.wave.labels[part, None] == labels) == self.wave.same_label
            for slot in range(self.wave.slots.shape[1]):
                low, high = self.wave.slots[part, slot].T
                low = np.maximum(low, self.floors[part, slot])
                anchor, row = np.nonzero(
                    other & (scores >= low[:, None]) & (scores <= high[:, None])
                )
                self.hold(anchor + begin, slot, scores[anchor, row], ids[row])

    def hold(self, anchor, slot, score, ids) -> None:
        self.held.append(np.stack([anchor, np.full_like(anchor, slot), score, ids]))
        self.waiting += len(anchor)
        if self.waiting > self.room:
            self.settle()

    def settle(self) -> np.ndarray:
        """Drop what is not among the best of its slot; raise the floors of full slots."""
        rows = np.concatenate([np.empty((4, 0), np.int64), *self.held], axis=1)
        anchor, slot, score, ids = rows
        rows = rows[:, np.lexsort((ids, ~score, slot, anchor))]
        group = rows[0] * self.floors.shape[1] + rows[1]
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        rank = np.arange(len(group)) - np.repeat(begins, np.diff([*begins, len(group)]))
        last = rank == self.wave.k - 1
        self.floors[rows[0, last], rows[1, last]] = rows[2, last]
        rows = rows[:, rank < self.wave.k]
        self.held, self.waiting = [rows], rows.shape[1]
        return rows


FOUND = "anchor long, slot long, score long, vec_id long"


def best_rows(rows: DataFrame, wave: Wave) -> DataFrame:
    """The best rows of each slot: ``anchor`` (its place in the wave), slot, score, vec_id, rank."""
    shipped = rows.sparkSession.sparkContext.broadcast(wave)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(shipped.value)
        for batch in batches:
            best.add(batch)
        columns = [pa.array(c) for c in best.settle()]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "score", "vec_id"])

    in_order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return (
        rows.mapInArrow(find, FOUND)
        .withColumn("place", F.row_number().over(in_order))
        .where(F.col("place") <= wave.k)
    )


def with_floors(rows: DataFrame, wave: Wave) -> Wave:
    """The wave with the score that each slot's ``k``-th best row of a part of the rows has."""
    part = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(PILOT)) == 0)
    found = best_rows(part, wave).where(F.col("place") == wave.k)
    for r in found.select("anchor", "slot", "score").collect():
        wave.floors[r.anchor, r.slot] = r.score
    return wave


def taking_part(rows: DataFrame) -> DataFrame:
    vector, label = own(rows, "embedding"), own(rows, "label")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return rows.where(label.isNotNull() & vector.isNotNull() & finite).select(
        own(rows, "vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        vector.cast("array<double>").alias("embedding"),
    )


def relabelled(rows: DataFrame) -> DataFrame:
    """The task's wrong labels: of ids divisible by 7, the next one of ten."""
    vec_id, label = own(rows, "vec_id"), own(rows, "label")
    wrong = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    vector = own(rows, "embedding")
    return rows.select(vec_id.alias("vec_id"), wrong.alias("label"), vector.alias("embedding"))


def waves_of(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Distinct anchors with the number of their wave, written, and the number of waves.

    Waves are drawn by hash, of distinct anchors, and half full on average; a wave beyond the
    bound raises before it is collected.
    """
    distinct = anchors.distinct()
    size = distinct.agg(
        F.count("*").alias("n"), F.max(F.array_size("embedding")).alias("width")
    ).first()
    room = max(1, min(WAVE_ANCHORS, WAVE_BYTES // (8 * max(1, size.width or 1))))
    number = -(-size.n // max(1, room // 2))
    wave = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(max(1, number)))
    staged = write_stage(distinct.withColumn("wave", wave), "anchors")
    largest = staged.groupBy("wave").count().agg(F.max("count")).first()[0] or 0
    if largest > 2 * room:
        raise ValueError(f"{largest} anchors in one wave")
    return staged, number


def collected(anchors: DataFrame) -> Wave:
    got = anchors.select("vec_id", "label", "embedding").toArrow().combine_chunks()
    vectors = got.column("embedding").combine_chunks()
    count = len(got)
    slots = np.tile(np.array([NOTHING, LAST_ID]), (count, 1, 1))
    return Wave(
        got.column("vec_id").to_numpy(),
        got.column("label").to_numpy(),
        integer_vectors(vectors, 0),
        True,
        slots,
        np.full((count, 1), NOTHING),
        POSITIVES,
    )


def windows(positive: int) -> tuple[int, int]:
    """The lowest and highest score of a negative; the lowest is higher if there is none."""
    return -(-LOWEST * positive // 100), HIGHEST * positive // 100


def negative_slots(wave: Wave, positives: list) -> Wave:
    """The wave with the slots between the upper limits of each anchor's positives."""
    limits: list[dict[int, int]] = [{} for _ in wave.ids]
    for r in positives:
        low, high = windows(r.score)
        if low <= high:
            limits[r.anchor][high] = min(low, limits[r.anchor].get(high, low))
    slots = np.tile(np.array([0, -1]), (len(wave.ids), POSITIVES, 1))
    for anchor, own_limits in enumerate(limits):
        below = None
        for slot, (high, low) in enumerate(sorted(own_limits.items())):
            slots[anchor, slot] = (low if below is None else max(low, below + 1)), high
            below = high
    floors = np.full((len(wave.ids), POSITIVES), NOTHING)
    return Wave(wave.ids, wave.labels, wave.vectors, False, slots, floors, NEGATIVES)


def answers(positives: DataFrame, found: DataFrame) -> DataFrame:
    """For each positive the first rows of the slots from its own on, down to its lower limit."""
    in_order = F.sort_array(F.collect_list(F.struct(F.negative("score").alias("minus"), "vec_id")))
    # At most NEGATIVES rows of each of POSITIVES slots.
    slots = found.groupBy("anchor").agg(in_order.alias("rows"))
    wide = "decimal(20,0)"
    low, high = (F.lit(n) * F.col("score").cast(wide) for n in (LOWEST, HIGHEST))

    def inside(r):
        return (-100 * r["minus"].cast(wide)).between(low, high)

    row = F.posexplode(F.slice(F.filter("rows", inside), 1, NEGATIVES)).alias("place", "row")
    return (
        positives.select("anchor", F.col("vec_id").alias("positive"), "score")
        .join(slots, "anchor")
        .select("anchor", "positive", "score", row)
        .select(
            "anchor",
            id_of("positive").alias("positive_id"),
            (F.col("place") + 1).alias("rank"),
            id_of("row.vec_id").alias("negative_id"),
            F.col("score").alias("positive_score"),
            F.negative("row.minus").alias("negative_score"),
        )
    )


def id_of(name: str) -> Column:
    return F.when(F.col(name) != LAST_ID, F.col(name))


def mine_hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on them.
    """
    spark = rows.sparkSession
    taking = taking_part(rows)
    anchors, number = waves_of(taking.where(is_anchor & F.col("vec_id").isNotNull()))
    parts = []
    for n in range(number):
        wave = collected(anchors.where(F.col("wave") == n))
        if not len(wave.ids):
            continue
        positives = write_stage(best_rows(taking, with_floors(taking, wave)), "positives")
        slots = negative_slots(wave, positives.collect())
        found = best_rows(taking, with_floors(taking, slots))
        ids = spark.createDataFrame(
            pa.table({"anchor": np.arange(len(wave.ids)), "anchor_id": wave.ids})
        )
        mined = answers(positives, found).join(ids, "anchor")
        parts.append(write_stage(mined.select(*RESULT), "negatives"))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


SCHEMA = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)
RESULT = [field.split()[0] for field in SCHEMA.split(", ")]


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")
