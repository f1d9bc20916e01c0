"""Packing of documents into as few sequences as can be found, by bin completion.

How full sequences get depends on lengths alone, and there are at most ``window`` different ones.
So Spark counts the pieces of each length, a branch and bound search plans sequences for the
counts, and Spark deals the pieces out to the plan by their rank in their length. The search sees
``window`` numbers however many documents there are; its result is some thousand kinds of
sequences, each with the number of times it occurs.

The search fills a sequence around the longest piece left: it takes in turn the undominated
fillings of the rest, those that leave least room first, each as often as the counts allow and then
once. A branch ends where the sequences so far and a lower bound for the others reach the best
plan known, and a filling that leaves more room than that plan can spare is not looked at. The
first plan known is best fit by descending length. The search ends when the lower bound is reached,
or after ``NODES`` steps with the best plan found; with few pieces it is complete.

A null text counts as empty, so a document is never without a piece. Repeated rows are packed each.
Very long texts are cut into pieces of ``window`` ids. An empty table gives no rows, and columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import own, whole_text
from martloom.llm.word_ids import slices, word_encoder
from martloom.session import write_stage

#: Steps of the search, of one filling's enumeration, and fillings tried at a place.
NODES, STEPS, BRANCHES = 10_000, 400, 6
#: Steps of an enumeration that has found a filling without room left.
EXACT_STEPS = 80

#: Lengths with the number of pieces of each, longest first.
Filling = tuple[tuple[int, int], ...]
Plan = list[tuple[Filling, int]]


def lower_bound(counts: np.ndarray, window: int) -> int:
    """Sequences that any packing of the pieces needs.

    For each least length ``a``, pieces over ``window - a`` stand alone among those of ``a`` or
    more, others over half a window stand apart, and the rest fill what these leave or need more.
    """
    sizes = np.arange(window + 1)
    total = -(-int(counts @ sizes) // window)
    half = window // 2
    number, length = np.cumsum(counts), np.cumsum(counts * sizes)
    a = np.arange(half + 1)
    alone = number[window] - number[window - a]
    apart = number[window - a] - number[half]
    room = apart * window - (length[window - a] - length[half])
    rest = length[half] - np.where(a > 0, length[a - 1], 0)
    best = alone + apart + np.maximum(0, -((room - rest) // window))
    return max(total, int(best.max(initial=0)))


def best_fit(counts: np.ndarray, window: int) -> Plan:
    """Best fit by descending length; equal sequences are filled together."""
    kinds: dict[int, list[tuple[Filling, int]]] = {window: []}
    rooms: list[int] = []

    def put(room: int, filling: Filling, number: int) -> None:
        if room not in kinds:
            kinds[room] = []
        if not kinds[room] and room < window:
            bisect.insort(rooms, room)
        kinds[room].append((filling, number))

    for size in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[size])
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                filling, number = kinds[room].pop()
                if not kinds[room]:
                    del rooms[at]
            else:
                room, filling, number = window, (), left
            each = min(room // size, left)
            used = min(number, left // each)
            put(room - each * size, (*filling, (size, each)), used)
            if filling and number > used:
                put(room, filling, number - used)
            left -= used * each
    full = kinds.pop(0, [])
    return full + [kind for kinds_of_room in kinds.values() for kind in kinds_of_room]


class Fillings:
    """Undominated fillings of a room by the pieces left, least room left over first."""

    def __init__(self, counts: np.ndarray, room: int, longest: int, spare: int):
        self.counts, self.spare, self.steps = counts, spare, STEPS
        self.found: dict[Filling, int] = {}
        self.sizes = np.flatnonzero(counts[: min(room, longest) + 1])
        self.there = counts > 0
        self.there[longest + 1 :] = False
        packed = np.packbits(self.there, bitorder="little")
        self.bits = int.from_bytes(packed.tobytes(), "little")
        self.room, self.exact = room, 0

    def all(self) -> list[Filling]:
        # A single piece that fills the room dominates everything else.
        if self.room == 0:
            return [()]
        if len(self.sizes) and self.sizes[-1] == self.room:
            return [((self.room, 1),)]
        self.search(self.room, len(self.sizes), ())
        good = [(left, f) for f, left in self.found.items() if not self.dominated(f, left)]
        good.sort(key=lambda x: (x[0], sum(n for _, n in x[1]), [-s for s, _ in x[1]]))
        return [f for _, f in good[:BRANCHES]]

    def search(self, room: int, end: int, chosen: Filling) -> None:
        """Fillings by the first ``end`` sizes, longest pieces first."""
        end = int(np.searchsorted(self.sizes[:end], room, "right"))
        self.steps -= 1
        if self.exact and self.steps < STEPS - EXACT_STEPS:
            self.steps = 0
        if not end:
            if room <= self.spare:
                self.found.setdefault(chosen, room)
            return
        self.close(room, end, chosen)
        for i in range(end - 1, -1, -1):
            size = int(self.sizes[i])
            for number in range(min(room // size, int(self.counts[size])), 0, -1):
                if self.steps <= 0:
                    return
                self.search(room - number * size, i, (*chosen, (size, number)))
        # What is left unfilled must be too small for any piece left, or it is dominated.

    def close(self, room: int, end: int, chosen: Filling) -> None:
        """Fillings that one or two more sizes complete exactly."""
        last = int(self.sizes[end - 1])
        if last == room:
            self.found.setdefault((*chosen, (room, 1)), 0)
        low = max(room - last, 1)
        pairs = np.flatnonzero(
            self.there[low : room // 2 + 1] & self.there[room - low : room - room // 2 - 1 : -1]
        )
        for less in (low + pairs[:2]).tolist():
            more, self.exact = room - less, self.exact + 1
            if more != less:
                self.found.setdefault((*chosen, (more, 1), (less, 1)), 0)
            elif self.counts[less] > 1:
                self.found.setdefault((*chosen, (less, 2)), 0)

    def dominated(self, filling: Filling, left: int) -> bool:
        """Whether one longer piece could stand for some of these and still fit."""
        sums, there, same = 1, self.bits, 0
        for size, number in filling:
            for _ in range(number):
                sums |= sums << size
            if self.counts[size] == number:
                there &= ~(1 << size)
            same |= 1 << size
        sums &= ~1
        return bool(sums & there & ~same or left and smeared(sums, left) & there)


def smeared(bits: int, most: int) -> int:
    """Each bit moved up by 1 to ``most`` places."""
    out, reach = bits << 1, 1
    while reach < most:
        step = min(reach, most - reach)
        out |= out << step
        reach += step
    return out


@dataclass
class Place:
    """A point of the search: fillings not yet tried, and what the one being tried took."""

    ways: Iterator[tuple[Filling, int]]
    taken: tuple[Filling, int] | None = None


@dataclass
class Search:
    """Depth-first search for a plan with fewer sequences than the best one known."""

    counts: np.ndarray
    window: int
    best: Plan
    made: Plan = field(default_factory=list)
    nodes: int = NODES

    def run(self) -> Plan:
        counts = self.counts
        least = lower_bound(counts, self.window)
        fewest, used = number_of(self.best), 0
        places = [Place(self.ways(used, fewest))]
        while places and fewest > least and self.nodes > 0:
            place = places[-1]
            if place.taken:
                self.change(*place.taken, +1)
                used -= self.made.pop()[1]
                place.taken = None
            way = next(place.ways, None)
            if way is None:
                places.pop()
                continue
            self.nodes -= 1
            place.taken = way
            self.change(*way, -1)
            self.made.append(way)
            used += way[1]
            if used + lower_bound(counts, self.window) >= fewest:
                continue
            if not counts.any():
                fewest, self.best = used, list(self.made)
                continue
            places.append(Place(self.ways(used, fewest)))
        return self.best

    def change(self, filling: Filling, times: int, sign: int) -> None:
        for size, number in filling:
            self.counts[size] += sign * number * times

    def ways(self, used: int, fewest: int) -> Iterator[tuple[Filling, int]]:
        """The fillings around the longest piece left, as often as can be and then once."""
        present = np.flatnonzero(self.counts)
        if not len(present):
            return
        longest = int(present[-1])
        tokens = int(self.counts @ np.arange(self.window + 1))
        spare = (fewest - 1 - used) * self.window - tokens
        self.counts[longest] -= 1
        fillings = Fillings(self.counts, self.window - longest, longest, spare).all()
        self.counts[longest] += 1
        wholes = [with_piece(f, longest) for f in fillings]
        often = [min(int(self.counts[s]) // n for s, n in f) for f in wholes]
        yield from zip(wholes, often, strict=True)
        yield from ((f, 1) for f, n in zip(wholes, often, strict=True) if n > 1)


def with_piece(filling: Filling, size: int) -> Filling:
    if filling and filling[0][0] == size:
        return ((size, filling[0][1] + 1), *filling[1:])
    return ((size, 1), *filling)


def number_of(plan: Plan) -> int:
    return sum(times for _, times in plan)


def plan_sequences(counts: np.ndarray, window: int) -> Plan:
    """Kinds of sequences and how often each occurs, for ``counts`` pieces of each length."""
    counts = counts.astype(np.int64)
    return Search(counts, window, best_fit(counts, window)).run()


PIECE = "piece int, start long, length long, ids_crc32 long, part int, rank long"


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Pieces of at most ``window`` ids, each with its task and its rank there by length; written.

    Also ``ids``, the piece's ids as unsigned little-endian 32-bit integers.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, met = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        ending = end_id.to_bytes(4, "little")
        for batch in batches:
            begin = 0
            for texts in slices(batch.column("text")):
                ids, places = word_encoder(tokenizer).all(texts)
                doc_ids = batch.column("doc_id").slice(begin, len(texts))
                begin += len(texts)
                rows: list[tuple] = []
                for n in range(len(texts)):
                    own_ids = ids[places[n] : places[n + 1]] + ending
                    for piece, at in enumerate(range(0, len(own_ids), 4 * window)):
                        part_ids = own_ids[at : at + 4 * window]
                        length = len(part_ids) // 4
                        crc = zlib.crc32(part_ids)
                        rows.append((n, piece, at // 4, length, crc, part, met[length], part_ids))
                        met[length] += 1
                number, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(number)),
                        *(pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)),
                    ],
                    names=["doc_id", *NAMES],
                )

    source = docs.select(
        own(docs, "doc_id").alias("doc_id"), whole_text(own(docs, "text")).alias("text")
    )
    return source.mapInArrow(cut, f"doc_id {kind}, {PIECE}, ids binary")


TYPES = [
    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()
]
NAMES = ["piece", "start", "length", "ids_crc32", "part", "rank", "ids"]


def ranked(pieces: DataFrame) -> DataFrame:
    """``rank`` counted over all tasks, in order of their numbers, within each length."""
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    return pieces.join(offsets, ["length", "part"]).withColumn(
        "rank", F.col("rank") + F.col("before")
    )


@dataclass
class Slots:
    """For ranges of ranks of each length, sorted: where the pieces go.

    The piece of rank ``first + i`` is number ``i % each`` in sequence ``sequence + i // each``,
    and the first such piece of a sequence begins at ``offset``.
    """

    keys: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, length * SPREAD + rank, "right") - 1
        i, each = rank - self.first[at], self.each[at]
        return self.sequence[at] + i // each, self.offset[at] + i % each * length


#: More than the pieces of any length.
SPREAD = 1 << 48


def slots_of(plan: Plan, window: int) -> Slots:
    """One range for each length of each kind of sequence."""
    rows, met, sequence = [], np.zeros(window + 1, np.int64), 0
    for filling, times in plan:
        offset = 0
        for size, each in filling:
            rows.append((size * SPREAD + met[size], met[size], each, sequence, offset))
            met[size] += each * times
            offset += size * each
        sequence += times
    rows.sort()
    return Slots(*np.array(rows, np.int64).reshape(-1, 5).T.copy())


def pack_fewest(
    docs: DataFrame, tokenizer: str, end_id: int, window: int, with_ids: bool = False
) -> DataFrame:
    """A row for each piece: where it begins in its document, and its sequence and place there.

    ``tokenizer`` is a file of the tokenizers library; each document gets ``end_id`` at its end.
    ``ids_crc32`` is the checksum of the piece's ids as little-endian 32-bit integers; ``with_ids``
    adds these as ``ids``.
    """
    cut = cut_documents(docs, tokenizer, end_id, window)
    pieces = write_stage(cut if with_ids else cut.drop("ids"), "pieces")
    counts = np.zeros(window + 1, np.int64)
    # At most a row for each length.
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    shipped = docs.sparkSession.sparkContext.broadcast(
        slots_of(plan_sequences(counts, window), window)
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            found = shipped.value.place(length, rank)
            kept = [batch.column(c) for c in out.names[:-2]]
            columns = [*kept, *(pa.array(c, pa.int64()) for c in found)]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    out = pieces.drop("part", "rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked(pieces).mapInArrow(place, out)
