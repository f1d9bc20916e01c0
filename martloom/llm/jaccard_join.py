"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Two documents link when the Jaccard similarity of their shingle sets reaches a share. The join
is exact: candidates are a superset of the links, and each is verified on whole sets.

Light sets, below a boundary, enumerate subsets of fixed sizes. Sets of a and b shingles link
only if they have c(a, b) in common, so they share a subset of that size, and each enumerates
its subsets of every size that a partner may ask for.

Heavy sets scan inverted lists. Sets that link differ in d shingles at most, d following from
their sizes; if the shingles are dealt by hash to more than d segments, one segment at least
is the same in both. The lists lead from the contents of a segment to the sets that have it.
A segment of some nine shingles is much rarer than any shingle, so passages that many documents
share don't make long lists. Light sets that may link to heavy ones are in the lists too.

The boundary is where the subsets to enumerate outweigh the list entries to scan, as counted.

No pairs of all members of a list are made. Every list has a centre, the member with the most
and longest lists, which among copies is the text they were made from. All members are first
held against their centres, and components of the links found are built: linear work, which
settles lists however long of true near copies. Members that are in another component than
their centre are then compared with all members of its lists, in tiles of bounded size, each
in one task, which gives only links between components.

Whole sets are shipped only for what small sketches don't rule out. The sketch of a set has some
two bits for a shingle: each shingle flips the bit that its hash names. Sketches of two sets
differ in no more bits than the sets do in shingles, so a pair with more than a link allows is
no link, and nothing else is decided by them. Sketches of double length are folded in half.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import let_go, own, sliced, unused, whole_text
from martloom.session import write_stage

#: Words of a shingle, if a caller doesn't say otherwise.
SHINGLE_WORDS = 3
#: The share as a fraction.
SHARE = (90, 100)
#: Sizes from one scheme of segments to the next grow by this factor.
GROWTH = 1.5
#: Segments above the least number, at least.
SPARE = 2
#: The boundary between light and heavy sets is below this size.
LARGEST_LIGHT = 40
#: Members of a centre's lists on each side of a tile.
TILE = 1024
#: Bits of a sketch for each shingle, at least; the length is 64 times a power of two.
SKETCH_BITS = 2
#: Columns of a tile's matrix of shingles that are multiplied at once.
STRIPE = 4096
#: Words, and sets already seen, that a task keeps at once.
WORDS, ENTRIES = 100_000, 300_000

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)
HALF = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX2
    return (x ^ (x >> np.uint64(27))) * MIX


class Words(dict):
    """64-bit hashes of words, kept for a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: str, words: Words, n_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit hashes.

    A-Z count as a-z, and words are cut at ASCII white space. With fewer words than a shingle
    has, the sequence of them is the one shingle; with none, the set is empty.
    """
    split = text.encode().lower().split()  # of bytes: only ASCII is lowered and cut
    if not split:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    length = min(n_words, len(split))
    out = np.full(len(split) - length + 1, length, np.uint64)
    for i in range(length):
        out = mixed(out * MIX + hashes[i : len(split) - length + 1 + i])
    return np.unique(out)


# --- what sizes allow -------------------------------------------------------------------


@functools.lru_cache(maxsize=4096)
def overlaps(size: int, share: tuple[int, int]) -> tuple[int, ...]:
    """How many shingles a set must have in common with a linked partner, over their sizes."""
    part, of = share
    sizes = range(-(-part * size // of), size * of // part + 1)
    return tuple(sorted({-(-part * (size + b) // (of + part)) for b in sizes}))


def subset_count(size: int, share: tuple[int, int]) -> int:
    return sum(math.comb(size, c) for c in overlaps(size, share))


@functools.lru_cache(maxsize=1)
def scheme_starts() -> list[int]:
    """Scheme j is for pairs whose smaller set has from starts[j] to starts[j + 1] - 1."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * GROWTH)))
    return starts


@functools.lru_cache(maxsize=4096)
def segments_for(size: int, allowed: int) -> int:
    """Segments for pairs of sets of so many shingles, or more, that may differ in ``allowed``.

    A set with more than ``allowed`` segments that aren't empty has one that is equal in a partner
    and not empty, and lists no empty ones. These are what sets without anything in common
    share, in lists that grow with the documents, so there are enough segments that all but few
    sets (four standard deviations) can do without them; sets of few shingles can't.
    """
    least = allowed + 1 + SPARE
    for segments in range(least, 2 * least):
        empty, two_empty = (1 - 1 / segments) ** size, (1 - 2 / segments) ** size
        spread = segments * (segments - 1) * two_empty + segments * empty * (1 - segments * empty)
        if segments * (1 - empty) - 4 * math.sqrt(max(spread, 0.0)) > allowed:
            return segments
    return least


@functools.lru_cache(maxsize=65536)
def schemes(size: int, share: tuple[int, int]) -> tuple[tuple[int, int, int], ...]:
    """(number, segments, difference allowed) of the schemes that a set of this size is in."""
    starts, (part, of) = scheme_starts(), share
    out = []
    for j in range(len(starts) - 1):
        largest = starts[j + 1] - 1
        if starts[j] <= size and largest >= -(-part * size // of):
            allowed = largest * (of - part) // part
            out.append((j, segments_for(starts[j], allowed), allowed))
    return tuple(out)


# --- signatures -------------------------------------------------------------------------


def list_signatures(shingles: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """One hash for each scheme and segment of a set, of the shingles in the segment."""
    out, contents = [], mixed(shingles)
    for number, segments, allowed in schemes(len(shingles), share):
        # Shingles are sorted, and so are the segments that their high bits give.
        at = (shingles >> HALF) * np.uint64(segments) >> HALF
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums, held = np.add.reduceat(contents, first), at[first]
        if len(first) <= allowed:
            # All of these may differ in a partner: the empty ones are listed too.
            empty = np.setdiff1d(np.arange(segments, dtype=np.uint64), held)
            sums, held = np.append(sums, np.zeros(len(empty), np.uint64)), np.append(held, empty)
        place = np.full(len(held), number + 1, np.uint64) * MIX + held
        out.append(mixed(mixed(place) + sums))
    return np.concatenate(out)


def subset_signatures(shingles: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """One hash for each subset of the sizes that partners ask for."""
    contents, size = mixed(shingles), len(shingles)
    total, out = contents.sum(), []
    for common in overlaps(size, share):
        left = size - common
        gone = np.fromiter(
            itertools.chain.from_iterable(itertools.combinations(range(size), left)), np.int64
        ).reshape(math.comb(size, left), left)
        sums = total - contents[gone].sum(axis=1, dtype=np.uint64)
        out.append(mixed(mixed(np.full(1, common, np.uint64) * MIX2) + sums))
    return np.concatenate(out)


def sketch(shingles: np.ndarray) -> bytes:
    """Bits that are set where an odd number of shingles falls on them."""
    blocks = -(-SKETCH_BITS * len(shingles) // 64)
    bits = 64 << (blocks - 1).bit_length()
    at = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketches: np.ndarray, length: int) -> np.ndarray:
    """Sketches, one a row of 64-bit numbers, at a length that theirs is a multiple of."""
    while sketches.shape[-1] > length:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def may_link(differing, sizes, share: tuple[int, int]):
    """Whether sets with so many shingles together, and differing in so many or more, may link."""
    part, of = share
    return (of + part) * differing <= (of - part) * sizes


def as_longs(arrays: list) -> pa.Array:
    """Lists of longs from arrays of unsigned hashes; None stays null."""
    return pa.array(
        [None if a is None else a.view(np.int64) for a in arrays], pa.list_(pa.int64())
    )


def summarised(
    batches: Iterator[pa.RecordBatch], share: tuple[int, int], n_words: int
) -> Iterator:
    """Size, digest, list signatures, sketch and, of small sets, the shingles.

    Of equal sets that a task meets, the first carries signatures: a hot text costs one set of
    list entries for each task, not one for each copy.
    """
    let_go()
    words, seen = Words(), set()
    for batch in sliced(batches):
        sizes, digests, lists, sketches, small = [], [], [], [], []
        for text in batch["text"].to_pylist():
            shingles = shingle_set(text, words, n_words)
            digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
            sizes.append(len(shingles))
            digests.append(digest)
            if len(seen) >= ENTRIES:
                seen.clear()
            fresh = len(shingles) > 0 and digest not in seen
            seen.add(digest)
            lists.append(list_signatures(shingles, share) if fresh else None)
            sketches.append(sketch(shingles) if fresh else None)
            small.append(shingles if fresh and len(shingles) < LARGEST_LIGHT else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch["key"],
                batch["text_key"],
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                as_longs(lists),
                pa.array(sketches, pa.binary()),
                as_longs(small),
            ],
            ["key", "text_key", "size", "digest", "lists", "sketch", "small"],
        )


def set_table(
    docs: DataFrame, key: str, text: str, share: tuple[int, int], n_words: int = SHINGLE_WORDS
) -> DataFrame:
    content = whole_text(own(docs, text))
    kind = docs.schema[key].dataType.simpleString()
    return write_stage(
        docs.select(
            own(docs, key).alias("key"),
            F.xxhash64(content).alias("text_key"),
            content.alias("text"),
        )
        .mapInArrow(
            lambda batches: summarised(batches, share, n_words),
            f"key {kind}, text_key long, size long, digest binary, lists array<long>, "
            "sketch binary, small array<long>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "shingle-sets",
    )


# --- the boundary -----------------------------------------------------------------------


def choose_boundary(sets: DataFrame, share: tuple[int, int]) -> int:
    """The size from which sets are heavy: subsets below it and list entries above cost least.

    Counts are of all sets below ``LARGEST_LIGHT``; larger ones are heavy in any case.
    """
    small = sets.where(F.col("small").isNotNull())
    entries = small.select("size", F.explode("lists").alias("signature"))
    lengths = entries.groupBy("signature").agg(F.count("*").alias("length"))
    scans = entries.join(lengths, "signature").groupBy("size").agg(F.sum("length").alias("scans"))
    costs = small.groupBy("size").count().join(scans, "size").collect()
    part, of = share

    def cost(boundary: int) -> int:
        listed = -(-part * boundary // of)
        return sum(
            (r["count"] * subset_count(r["size"], share) if r["size"] < boundary else 0)
            + (r["scans"] if r["size"] >= listed else 0)
            for r in costs
        )

    return min(range(1, LARGEST_LIGHT + 1), key=lambda boundary: (cost(boundary), boundary))


def enumerated(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator:
    for batch in batches:
        for row, small in zip(batch["row"].to_pylist(), batch["small"], strict=True):
            shingles = small.values.to_numpy().view(np.uint64)
            found = subset_signatures(shingles, share).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.full(len(found), row))], ["signature", "row"]
            )


def postings(sets: DataFrame, boundary: int, share: tuple[int, int]) -> DataFrame:
    """(signature, row): list entries of sets that heavy ones may link to, subsets of light."""
    part, of = share
    listed = sets.where(F.col("size") >= -(-part * boundary // of))
    light = sets.where((F.col("size") < boundary) & F.col("small").isNotNull())
    return listed.select(F.explode("lists").alias("signature"), "row").unionByName(
        light.select("row", "small").mapInArrow(
            lambda batches: enumerated(batches, share), "signature long, row long"
        )
    )


def memberships(entries: DataFrame) -> DataFrame:
    """(centre, row): the sets that share a signature with others, under each list's centre.

    Every two sets with a common signature are under one centre.
    """
    several = write_stage(
        entries.groupBy("signature").agg(F.count("*").alias("length")).where("length > 1"),
        "shared-signatures",
    )
    lists = write_stage(entries.join(several, "signature"), "lists")
    weights = write_stage(lists.groupBy("row").agg(F.sum("length").alias("weight")), "weights")
    best = F.max(F.struct("weight", (-F.col("row")).alias("row")))
    centres = write_stage(
        lists.join(weights, "row")
        .groupBy("signature")
        .agg(best.alias("best"))
        .select("signature", (-F.col("best.row")).alias("centre")),
        "centres",
    )
    return write_stage(
        lists.join(centres, "signature").select("centre", "row").distinct(), "memberships"
    )


# --- verification -----------------------------------------------------------------------


def tokenised(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    let_go()
    words = Words()
    for batch in sliced(batches):
        found = [shingle_set(text, words, n_words) for text in batch["text"].to_pylist()]
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), as_longs(found)], ["digest", "shingles"]
        )


def whole_sets(
    docs: DataFrame, wanted: DataFrame, text: str, n_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(digest, shingles) of the sets of the texts in ``wanted`` (text_key), from these again.

    ``wanted`` is a written table of one long a row, so the planner knows its size: below the
    broadcast threshold the texts are not shuffled, beyond it they are, once.
    """
    content = whole_text(own(docs, text))
    texts = docs.select(F.xxhash64(content).alias("text_key"), content.alias("text"))
    found = (
        texts.join(wanted, "text_key", "left_semi")
        .select("text")
        .mapInArrow(
            lambda batches: tokenised(batches, n_words), "digest binary, shingles array<long>"
        )
    )
    return write_stage(found.dropDuplicates(["digest"]), "whole-sets")


def close(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs that may link by their sketches, without these."""
    for batch in sliced(batches):
        sizes = batch["size_a"].to_numpy() + batch["size_b"].to_numpy()
        differing = np.zeros(len(sizes), np.int64)
        ends = zip(batch["sketch_a"], batch["sketch_b"], strict=True)
        for n, (a, b) in enumerate(ends):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            length = min(len(a), len(b))
            differing[n] = np.bitwise_count(folded(a, length) ^ folded(b, length)).sum()
        stay = pa.array(may_link(differing, sizes, share))
        yield batch.drop_columns(["sketch_a", "sketch_b"]).filter(stay)


def sized(pairs: DataFrame, nodes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs of rows (a, b) whose sizes and sketches allow a link, with sizes and digests, written."""
    part, of = share
    ends = nodes.select("row", "size", "digest", "sketch")
    for end in ("a", "b"):
        names = {"row": end} | {name: f"{name}_{end}" for name in ("size", "digest", "sketch")}
        pairs = pairs.join(ends.withColumnsRenamed(names), end)
    least, most = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    allowed = pairs.where(of * least >= part * most)
    columns = "a long, b long, size_a long, digest_a binary, size_b long, digest_b binary"
    names = [column.split()[0] for column in columns.split(", ")]
    return write_stage(
        allowed.select(*names, "sketch_a", "sketch_b").mapInArrow(
            lambda batches: close(batches, share), columns
        ),
        "pairs",
    )


def linked(pairs: DataFrame, whole: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Of sized pairs those whose sets link."""
    part, of = share
    equal = pairs.where("digest_a = digest_b").select("a", "b")
    held = pairs.where("digest_a <> digest_b")
    for end in ("a", "b"):
        held = held.join(
            whole.withColumnsRenamed({"digest": f"digest_{end}", "shingles": f"set_{end}"}),
            f"digest_{end}",
        )
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.col("size_a") + F.col("size_b") - common
    return held.where(of * common >= part * union).select("a", "b").unionByName(equal)


# --- components -------------------------------------------------------------------------


def components(links: DataFrame, label: str = "component") -> DataFrame:
    """(node, component) of all nodes with links (a, b): the least node that can be reached.

    In each round the ends of a link offer each other's label to themselves and to the node
    that their own label names, and a label is replaced by that node's label. So trees are
    hooked onto smaller ones and halved in height, and the rounds grow with the logarithm of
    a component's size. Labels are written in each round; a node with very many links or
    followers is one side of a join of written tables, which is split where it is skewed.
    """
    edges = write_stage(
        links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
        .distinct(),
        "edges",
    )
    labels = write_stage(
        edges.groupBy("u").agg(F.least(F.min("v"), "u").alias("label")).withColumnRenamed("u", "node"),
        "labels",
    )
    before = label_sum(labels)
    while True:
        of_u = labels.select(F.col("node").alias("u"), F.col("label").alias("of_u"))
        of_v = labels.select(F.col("node").alias("v"), F.col("label").alias("of_v"))
        offers = edges.join(of_v, "v").join(of_u, "u")
        offers = offers.select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("node"), F.col("of_v").alias("label")),
                    F.struct(F.col("of_u").alias("node"), F.col("of_v").alias("label")),
                )
            ).alias("offer")
        ).select("offer.*")
        best = offers.unionByName(labels).groupBy("node").agg(F.min("label").alias("named"))
        named = labels.select(F.col("node").alias("named"), F.col("label").alias("next"))
        labels = write_stage(
            best.join(named, "named").select("node", F.least("named", "next").alias("label")),
            "labels",
        )
        after = label_sum(labels)
        if after == before:
            return labels.where("label < node").withColumnsRenamed({"label": label})
        before = after


def label_sum(labels: DataFrame) -> int:
    """The sum of the labels, which only fall: equal when a round has changed nothing."""
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]


# --- tiles ------------------------------------------------------------------------------


def tiles(members: DataFrame, found: DataFrame) -> DataFrame:
    """(centre, kind, i, j, row, component, far): what must still be compared, tile by tile.

    Far members, those of another component than their centre, meet each other and the near
    ones; near ones are in one component. The rows made are members times tiles, not pairs.
    """
    at = found.withColumnRenamed("node", "row")
    of_centre = at.withColumnsRenamed({"row": "centre", "component": "of_centre"})
    placed = (
        members.join(at, "row", "left")
        .join(of_centre, "centre", "left")
        .select(
            "centre",
            "row",
            F.coalesce("component", "row").alias("component"),
            F.coalesce("of_centre", "centre").alias("of_centre"),
        )
        .withColumn("far", F.col("component") != F.col("of_centre"))
    )
    placed = write_stage(placed.drop("of_centre"), "placed-members")
    blocks = placed.groupBy("centre").agg(
        F.ceil(F.count_if("far") / TILE).cast("int").alias("far_blocks"),
        F.ceil(F.count_if(~F.col("far")) / TILE).cast("int").alias("near_blocks"),
        F.count("*").alias("members"),
    )
    # Two members are a centre and one that was compared with it.
    blocks = write_stage(
        blocks.where("far_blocks > 0 AND members > 2").drop("members"), "open-centres"
    )
    blocked = placed.join(blocks, "centre").withColumn(
        "block",
        F.pmod(
            F.xxhash64("row"), F.when(F.col("far"), F.col("far_blocks")).otherwise(F.col("near_blocks"))
        ).cast("int"),
    )

    def each(count: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)

    def tile(kind: str, i, j) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    block = F.col("block")
    among_far = each("far_blocks", lambda k: tile("far", F.least(k, block), F.greatest(k, block)))
    to_near = F.when(
        F.col("near_blocks") > 0, each("near_blocks", lambda k: tile("near", block, k))
    ).otherwise(F.expr("cast(array() AS array<struct<kind:string,i:int,j:int>>)"))
    to_far = each("far_blocks", lambda k: tile("near", k, block))
    wanted = F.when(F.col("far"), F.concat(among_far, to_near)).otherwise(to_far)
    return blocked.select(
        "centre", "row", "component", "far", F.explode(wanted).alias("tile")
    ).select("centre", "tile.*", "row", "component", "far")


def tile_candidates(table: pa.Table, share: tuple[int, int]) -> pa.Table:
    """The rows of a tile that may link to a row of another component, by size and sketch.

    Rows are taken by size, and each is held against the larger ones that sizes allow. In a tile
    of far and near rows, only one with the other.
    """
    part, of = share
    table = table.sort_by("size")
    size, label = table["size"].to_numpy(), table["component"].to_numpy()
    far, near_tile = table["far"].to_numpy(), table["kind"][0].as_py() == "near"
    sketches = table["sketch"].combine_chunks()
    length = np.array([len(x.as_buffer()) // 8 for x in sketches])
    last = np.searchsorted(size, size * of // part, side="right")
    found = np.zeros(len(size), bool)
    for words in np.unique(length).tolist():  # lengths ascend with the sizes
        first, end = np.searchsorted(length, [words, words + 1])
        block = np.empty((last[end - 1] - first, words), np.uint64)
        for n in range(len(block)):
            held = np.frombuffer(sketches[first + n].as_buffer(), np.uint64)
            block[n] = folded(held, words)
        for i in range(first, end):
            others = np.arange(i + 1, last[i])
            wanted = label[others] != label[i]
            if near_tile:
                wanted &= far[others] != far[i]
            others = others[wanted]
            differing = np.bitwise_count(block[others - first] ^ block[i - first]).sum(axis=1)
            others = others[may_link(differing.astype(np.int64), size[others] + size[i], share)]
            if len(others):
                found[i] = found[others] = True
    return table.filter(pa.array(found)).select(["centre", "kind", "i", "j", "row", "component"])


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets have in common, as a matrix."""
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    of, column = of[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, STRIPE):
        a, b = np.searchsorted(column, [first, first + STRIPE])
        stripe = np.zeros((len(sets), STRIPE), np.float32)
        stripe[of[a:b], column[a:b] - first] = 1
        out += stripe @ stripe.T
    return out


def tile_links(table: pa.Table, share: tuple[int, int]) -> pa.Table:
    """Links of a tile that join components: one for each two that it brings together."""
    part, of = share
    rows, label = table["row"].to_numpy(), table["component"].to_numpy()
    sets = [s.values.to_numpy() for s in table["shingles"].combine_chunks()]
    sizes = np.array([len(s) for s in sets])
    common = common_counts(sets)
    union = sizes[:, None] + sizes[None, :] - common
    link = (of * common >= part * union) & (label[:, None] != label[None, :])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in np.argwhere(np.triu(link, 1)).tolist():
        a, b = find(int(label[i])), find(int(label[j]))
        if a != b:
            root[a] = b
            out.append((int(rows[i]), int(rows[j])))
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def find_components(
    docs: DataFrame,
    sets: DataFrame,
    text: str,
    share: tuple[int, int],
    n_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(node, component) over the rows of ``sets`` that carry signatures and have links."""
    members = memberships(postings(sets, choose_boundary(sets, share), share))
    nodes = write_stage(
        sets.where(F.col("lists").isNotNull())
        .join(members.select("row").distinct(), "row", "left_semi")
        .select("row", "text_key", "size", "digest", "sketch"),
        "nodes",
    )

    def whole(rows: DataFrame) -> DataFrame:
        wanted = nodes.join(rows.distinct(), "row", "left_semi").select("text_key").distinct()
        return whole_sets(docs, write_stage(wanted, "wanted-texts"), text, n_words)

    spokes = members.where("row <> centre").select(F.col("centre").alias("a"), F.col("row").alias("b"))
    pairs = sized(spokes, nodes, share)
    open_rows = pairs.where("digest_a <> digest_b").select(F.explode(F.array("a", "b")).alias("row"))
    links = write_stage(linked(pairs, whole(open_rows), share), "links")
    found = components(links)
    candidates = write_stage(
        tiles(members, found)
        .join(nodes.select("row", "size", "sketch"), "row")
        .groupBy("centre", "kind", "i", "j")
        .applyInArrow(
            lambda table: tile_candidates(table, share),
            "centre long, kind string, i int, j int, row long, component long",
        ),
        "tile-candidates",
    )
    if candidates.isEmpty():
        return found
    sets_of_rows = nodes.select("row", "digest").join(whole(candidates.select("row")), "digest")
    more = write_stage(
        candidates.join(sets_of_rows.select("row", "shingles"), "row")
        .groupBy("centre", "kind", "i", "j")
        .applyInArrow(lambda table: tile_links(table, share), "a long, b long"),
        "tile-links",
    )
    return found if more.isEmpty() else components(links.unionByName(more))


def classes(
    docs: DataFrame, key: str, text: str, share: tuple[int, int], n_words: int = SHINGLE_WORDS
) -> tuple[DataFrame, DataFrame]:
    """The rows with the label of their component, and the first of each label.

    Rows of empty sets have no label.
    """
    sets = set_table(docs, key, text, share, n_words)
    found = find_components(docs, sets, text, share, n_words)
    labels = write_stage(
        sets.where(F.col("lists").isNotNull())
        .select("row", "digest")
        .join(found.withColumnRenamed("node", "row"), "row", "left")
        .groupBy("digest")
        .agg(F.min(F.coalesce("component", "row")).alias("label")),
        "set-labels",
    )
    rows = write_stage(
        sets.select("key", "text_key", "size", "row", "digest").join(labels, "digest", "left").drop("digest"),
        "labelled-rows",
    )
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "row", "text_key")
    firsts = write_stage(
        rows.where(F.col("label").isNotNull()).groupBy("label").agg(F.min(order).alias("first")),
        "component-firsts",
    )
    return rows, firsts


def jaccard_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: tuple[int, int] = SHARE,
    n_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id.

    ``component_id`` is the smallest key among the documents that links lead to, a null key
    last, the document's own included. Null and empty texts, and those without words, are
    empty sets and link with nothing. Equal texts link, and repeated rows get equal results.
    Other columns are not looked at; no rows give no rows.
    """
    rows, firsts = classes(docs, key, text, share, n_words)
    return rows.join(firsts, "label", "left").select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("key"))
        .otherwise(F.col("first.key"))
        .alias("component_id"),
    )


def has_words(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def keep_one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: tuple[int, int] = SHARE,
    n_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """Of each component the document with the smallest key, with all columns.

    Rows without words link with nothing, so all of them stay.
    """
    _, firsts = classes(docs, key, text, share, n_words)
    chosen = firsts.select("first.key", "first.text_key")
    content, text_key = whole_text(own(docs, text)), unused(docs, "text_key")
    wide = docs.where(has_words(content)).withColumn(text_key, F.xxhash64(content))
    same = own(wide, key).eqNullSafe(chosen["key"]) & (wide[text_key] == chosen["text_key"])
    stay = wide.join(chosen, same, "left_semi").dropDuplicates([key, text_key]).drop(text_key)
    return stay.unionByName(docs.where(~has_words(content)))
