"""Lexical retrieval packing: windows filled with documents that a BM25 index finds alike.

How many documents hold a token id, and how long documents are, is counted over the whole
corpus, and a document's strongest terms follow from it. Documents are placed by content: each
has a path, its strongest terms with those first that are strongest in many documents, and in
the order of paths they are cut into shards of bounded size. So documents that share strong
terms lie in one shard or in one beside it, however large the corpus. A common path is cut by
row number like any other stretch.

Each shard has an inverted index of its token ids, with BM25 weights from the corpus's counts.
A window begins with a seed document. All its terms are looked up, and the unused neighbours of
highest score fill the window; the one that doesn't fit is cut, and its rest is the seed of the
next window. So windows are full, and only a shard's last ids are left over; they are cut at
powers of two, which need no padding either.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import own, sliced, whole_text
from martloom.llm.token_ids import encoder
from martloom.session import scratch_folder, write_stage

WINDOW = 1024
SHARD_DOCUMENTS = 2048
#: A document is placed by the terms of at least this share of its highest weight, and at most
#: so many of them.
PLACE_SHARE, PLACE_TERMS = 0.6, 48
#: Shards that a task cuts from the ordered paths.
SHARDS_A_TASK = 16
#: Terms of more documents of a shard are looked up for all its documents at once, as a matrix.
LONG_LIST = 192
#: BM25's usual constants.
K1, B = 1.2, 0.75


class Corpus:
    """Counts over all documents: how many there are and hold each term, and their mean length."""

    def __init__(self, n: int, tokens: int, held: np.ndarray):
        self.n, self.mean, self.held = n, tokens / max(n, 1), held
        self.idf = np.log1p((n - held + 0.5) / (held + 0.5))

    def weights(self, terms: np.ndarray, counts: np.ndarray, lengths) -> np.ndarray:
        """BM25 weights of terms that occur ``counts`` times in documents of ``lengths``."""
        damping = K1 * (1 - B + B * lengths / self.mean)
        return self.idf[terms] * counts * (K1 + 1) / (counts + damping)

    def strongest(self, ids: np.ndarray) -> np.ndarray:
        """The terms of the highest weight, without those that no other document has."""
        terms, counts = bag(ids)
        shared = self.held[terms] > 1
        terms, counts = terms[shared], counts[shared]
        weights = self.weights(terms, counts, len(ids))
        high = weights >= PLACE_SHARE * weights.max(initial=0)
        return terms[high][np.argsort(-weights[high], kind="stable")[:PLACE_TERMS]]


def bag(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and how often each occurs."""
    small = ids.astype(np.uint16) if ids.max() < 1 << 16 else ids
    ordered = np.sort(small, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first].astype(np.int64), np.diff(np.append(first, len(ids)))


class Index:
    """Inverted lists of a shard's documents, with the BM25 weight of each posting.

    Without a corpus, the documents are the corpus.
    """

    def __init__(self, ids: list[np.ndarray], corpus: Corpus | None = None):
        n = len(ids)
        lengths = np.array([len(x) for x in ids])
        bags = [bag(x) for x in ids]
        sizes = [len(terms) for terms, _ in bags]
        terms = np.concatenate([t for t, _ in bags])
        counts = np.concatenate([c for _, c in bags]).astype(np.float64)
        docs = np.repeat(np.arange(n), sizes)
        held = np.bincount(terms)
        corpus = corpus or Corpus(n, int(lengths.sum()), held)
        weights = corpus.weights(terms, counts, lengths[docs])
        order = np.argsort(terms, kind="stable")
        self.docs, self.weights, self.n = docs[order], weights[order], n
        self.begin = np.concatenate([[0], np.cumsum(held)])
        # All terms are asked for, but those of one document, which find only itself.
        self.queries = [t[held[t] > 1] for t, _ in bags]
        self.short = [t[(held[t] > 1) & (held[t] <= LONG_LIST)] for t, _ in bags]
        self.long = self.long_scores(terms, docs, weights, held)

    def long_scores(self, terms, docs, weights, held) -> np.ndarray | None:
        """What terms with long lists add to the score of each document for each seed."""
        many = np.flatnonzero(held > LONG_LIST)
        if not len(many):
            return None
        place = np.full(len(held), -1)
        place[many] = np.arange(len(many))
        at = place[terms]
        docs, weights, at = docs[at >= 0], weights[at >= 0], at[at >= 0]
        of_doc = np.zeros((self.n, len(many)))
        of_doc[docs, at] = weights
        return (of_doc > 0).astype(np.float64) @ of_doc.T

    def scores(self, doc: int) -> np.ndarray:
        """The score of every document for the terms of one."""
        terms = self.short[doc]
        lists = [slice(a, b) for a, b in zip(self.begin[terms], self.begin[terms + 1], strict=True)]
        out = np.zeros(self.n) if self.long is None else self.long[doc]
        if not lists:
            return out
        docs = np.concatenate([self.docs[x] for x in lists])
        return out + np.bincount(docs, np.concatenate([self.weights[x] for x in lists]), self.n)


def chained(
    ids: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None
) -> list[int]:
    """The order in which a shard's documents fill its windows, one after the other.

    Each document is the best unused neighbour of the seed of the window it begins in; ties,
    and windows whose seed has no neighbour left, go to the first document.
    """
    index, unused = Index(ids, corpus), np.ones(len(ids), bool)
    order, filled, scores = [], 0, np.zeros(len(ids))
    for _ in ids:
        doc = int(np.argmax(np.where(unused, scores, -1.0)))
        unused[doc] = False
        order.append(doc)
        if filled == 0 or filled + len(ids[doc]) >= window:
            # It begins a window or reaches into the next one: the seed there.
            scores = index.scores(doc)
        filled = (filled + len(ids[doc])) % window
    return order


def windows(total: int, window: int = WINDOW) -> list[int]:
    """Lengths of a shard's sequences: full windows, then the powers of two of the rest."""
    rest = total % window
    return [window] * (total // window) + [
        1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1
    ]


def as_binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


def encoding(path: str, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """Ids of each document, and at the end of a task its counts: documents, ids, and holders."""

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(path), end.to_bytes(4, "little")
        terms = max(encode.tokenizer.get_vocab_size(), end + 1)
        counts, key = np.zeros(2 + terms, "<i8"), None
        kind = "<u2" if terms <= 1 << 16 else "<u4"
        for batch in sliced(batches):
            out, key = [], batch["key"]
            for raw in encode.each(batch["text"].to_pylist()):
                ids = np.frombuffer(raw + last, "<u4").astype(kind)
                counts[:2] += 1, len(ids)
                counts[2 + bag(ids)[0]] += 1
                out.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [key, batch["row"], as_binary(out), as_binary([None] * len(out))], ENCODED
            )
        if key is not None:
            none = pa.nulls(1, key.type)
            row = pa.array([None], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, row, as_binary([None]), as_binary([counts.tobytes()])], ENCODED
            )

    return encode_all


ENCODED = ["key", "row", "ids", "counts"]


def ids_kind(corpus: Corpus) -> str:
    return "<u2" if len(corpus.held) <= 1 << 16 else "<u4"


def summed(df: DataFrame, arrays: Callable[[pa.RecordBatch], np.ndarray]) -> dict[int, int]:
    """Arrays of counts, one from each batch, added by place; as many rows as terms at most."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                counts = arrays(batch)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["at", "n"]
                )

    sums = df.mapInArrow(spread, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    return {r["at"]: r["n"] for r in sums.collect()}


def count_corpus(encoded: DataFrame, path: str, end: int) -> Corpus:
    def added(batch: pa.RecordBatch) -> np.ndarray:
        return sum(np.frombuffer(x, "<i8") for x in batch["counts"].to_pylist())

    sums = summed(encoded.where("counts IS NOT NULL").select("counts"), added)
    held = np.zeros(max(encoder(path).tokenizer.get_vocab_size(), end + 1), np.int64)
    for at, n in sums.items():
        if at >= 2:
            held[at - 2] = n
    return Corpus(sums.get(0, 0), sums.get(1, 0), held)


def place(strong: np.ndarray, rank: np.ndarray, row: int) -> bytes:
    """A path and a row number, as bytes in the order of paths, then rows."""
    return np.sort(rank[strong]).astype(">u4").tobytes() + row.to_bytes(8, "big")


def shard_starts(
    documents: DataFrame, corpus: Corpus, shard_documents: int
) -> tuple[np.ndarray, list[bytes]]:
    """The rank of each term in paths, and the place at which each shard begins."""
    kind = ids_kind(corpus)

    def strong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [corpus.strongest(np.frombuffer(x, kind)) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], as_binary([x.astype("<u4").tobytes() for x in found])],
                ["row", "strong"],
            )

    terms = write_stage(
        documents.select("row", "ids").mapInArrow(strong, "row long, strong binary"), "strong-terms"
    )

    def uses(batch: pa.RecordBatch) -> np.ndarray:
        return np.bincount(np.frombuffer(b"".join(batch["strong"].to_pylist()), "<u4"))

    count = np.zeros(len(corpus.held), np.int64)
    for at, n in summed(terms.select("strong"), uses).items():
        count[at] = n
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(count))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["strong"].to_pylist(), batch["row"].to_pylist(), strict=True)
            places = [place(np.frombuffer(x, "<u4"), rank, row) for x, row in rows]
            yield pa.RecordBatch.from_arrays([as_binary(places)], ["place"])

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            first = -seen % shard_documents
            seen += batch.num_rows
            at = pa.array(range(first, batch.num_rows, shard_documents), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["place"].take(at)], ["place"])

    tasks = max(1, -(-corpus.n // (shard_documents * SHARDS_A_TASK)))
    starts = (
        terms.mapInArrow(placed, "place binary")
        .repartitionByRange(tasks, "place")
        .sortWithinPartitions("place")
        .mapInArrow(begun, "place binary")
        .collect()
    )
    return rank, sorted(bytes(r["place"]) for r in starts)


def dealt(corpus: Corpus, rank: np.ndarray, starts: list[bytes]) -> Callable:
    """The shard of each document, by its place."""
    kind = ids_kind(corpus)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["ids"].to_pylist(), batch["row"].to_pylist(), strict=True)
            places = [place(corpus.strongest(np.frombuffer(x, kind)), rank, row) for x, row in rows]
            shards = [bisect_right(starts, x) - 1 for x in places]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["ids"], pa.array(shards, pa.int64())], ["key", "ids", "shard"]
            )

    return deal


def packer(corpus: Corpus, window: int) -> Callable[[pa.Table], pa.Table]:
    kind = ids_kind(corpus)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("ids", "ascending")])
        ids = [np.frombuffer(x, kind).astype("<u4") for x in table["ids"].to_pylist()]
        shard, rows = table["shard"][0].as_py(), []
        lengths = windows(sum(map(len, ids)), window)
        sequence, room = 0, lengths[0]
        for doc in chained(ids, window, corpus):
            start, held = 0, ids[doc]
            while start < len(held):
                if not room:
                    sequence += 1
                    room = lengths[sequence]
                length = min(room, len(held) - start)
                crc = zlib.crc32(held[start : start + length])
                offset = lengths[sequence] - room
                rows.append((doc, start, length, crc, len(held), (shard << 32) + sequence, offset))
                start, room = start + length, room - length
        columns = [np.array(c, np.int64) for c in zip(*rows, strict=True)]
        return pa.Table.from_arrays(
            [table["key"].take(pa.array(columns[0])), *map(pa.array, columns[1:])],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    return pack


def pack_documents(
    docs: DataFrame,
    path: str,
    end: int = 0,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_documents: int = SHARD_DOCUMENTS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end``; a null or empty text is ``end`` alone. Every id lies in
    one piece. Rows are dealt to shards by their strongest terms, equal ones by their place in
    the input, so that no key or text can fill one. A null key is kept as null. No rows give no
    pieces. The number of shards follows the number of rows; a shard, and so a task, stays as
    large as before.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    folder = f"{scratch_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    fresh = docs.select(
        own(docs, key).alias("key"),
        whole_text(own(docs, text)).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).mapInArrow(encoding(path, end), f"key {kind}, row long, ids binary, counts binary")
    fresh.write.option("compression", "zstd").parquet(folder)
    encoded = spark.read.schema(fresh.schema).parquet(folder)
    corpus = count_corpus(encoded, path, end)
    rows = encoded.where("counts IS NULL").select("key", "row", "ids")
    rank, starts = shard_starts(rows, corpus, shard_documents)
    shards = rows.mapInArrow(dealt(corpus, rank, starts), f"key {kind}, ids binary, shard long")
    return shards.groupBy("shard").applyInArrow(
        packer(corpus, window),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )
