"""Token-id files: one zstandard frame per document, with one dictionary for all of them.

A file set is a folder with

``dictionary``  one row: the dictionary's bytes and their SHA-256,
``blocks``      Parquet files of blocks of about a megabyte. A block holds the frames of
                consecutive documents end to end (``frames``), where each begins
                (``offsets``, one more than documents), ``doc_ids``, ``n_tokens``, the
                SHA-256 of the dictionary it needs, and its place: ``part``, and
                ``before``, the ids of its part's earlier blocks.

Parts follow each other in the order of document ids, as do blocks in a part. One document
is read by its block's offsets alone, without decompressing its neighbours. Files are
written by Spark's own committer to any store; a lost task's files are never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import own, whole_text
from martloom.llm.token_ids import encoder
from martloom.session import scratch_folder

#: The dictionary: its size, and the sample it is trained on. The sample is bounded as any
#: dictionary is trained on one; all documents are encoded with it.
DICTIONARY_BYTES = 65_536
SAMPLE_DOCUMENTS = 1_000
SAMPLE_BYTES = 8_192
BLOCK_BYTES = 1 << 20
LEVEL = 3

BLOCKS = (
    "part int, before long, dictionary string, doc_ids array<{}>, n_tokens array<int>, "
    "offsets array<int>, frames binary"
)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; where the samples are too few to train on, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or bytes(8)


def opened(dictionary: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(dictionary)


def sampled_ids(docs: DataFrame, key: str, text: str, path: str, end: int) -> list[bytes]:
    """Serialized ids of about ``SAMPLE_DOCUMENTS`` documents, chosen by a hash."""
    rate = max(1, docs.count() // SAMPLE_DOCUMENTS)
    chosen = docs.select(own(docs, key).alias("key"), whole_text(own(docs, text)).alias("text"))
    chosen = chosen.where(F.pmod(F.xxhash64("key", "text"), F.lit(rate)) == 0)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, last = encoder(path), end.to_bytes(4, "little")
        for batch in batches:
            out = [(raw + last)[:SAMPLE_BYTES] for raw in ids.each(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    rows = chosen.select("text").mapInArrow(encoded, "ids binary").limit(SAMPLE_DOCUMENTS)
    return sorted(bytes(row.ids) for row in rows.collect())


def block_writer(path: str, end: int, dictionary: bytes, id_type: pa.DataType) -> Callable:
    digest = hashlib.sha256(dictionary).hexdigest()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, last = encoder(path), end.to_bytes(4, "little")
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=opened(dictionary)).compress
        part = TaskContext.get().partitionId()
        before, keys, counts, frames, held = 0, [], [], [], 0

        def block() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "dictionary": [digest],
                    "doc_ids": pa.array([keys], pa.list_(id_type)),
                    "n_tokens": pa.array([counts], pa.list_(pa.int32())),
                    "offsets": pa.array([offsets], pa.list_(pa.int32())),
                    "frames": pa.array([b"".join(frames)], pa.binary()),
                }
            )

        for batch in batches:
            found = ids.each(batch["text"].to_pylist())
            for key, raw in zip(batch["key"].to_pylist(), found, strict=True):
                raw += last
                keys.append(key)
                counts.append(len(raw) // 4)
                frames.append(compress(raw))
                held += len(frames[-1])
                if held >= BLOCK_BYTES:
                    yield block()
                    before += sum(counts)
                    keys, counts, frames, held = [], [], [], 0
        if keys:
            yield block()

    return blocks


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text, ``end`` after it, and write the file set.

    Documents are dealt out by ranges of the key; equal keys, which may be many, are ordered
    by a checksum of the text and so can be dealt to several ranges. Null keys come first,
    null texts count as empty, repeated rows are written as often as they occur.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(sampled_ids(docs, key, text, path, end))
    spark.createDataFrame(
        [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))],
        "sha256 string, bytes binary",
    ).coalesce(1).write.parquet(f"{folder}/dictionary")
    content = whole_text(own(docs, text))
    rows = docs.select(
        own(docs, key).alias("key"), F.crc32(content).alias("crc"), content.alias("text")
    )
    id_type = docs.schema[key].dataType
    arrow = pa.int64() if id_type.simpleString() == "bigint" else pa.string()
    if arrow == pa.string() and id_type.simpleString() != "string":
        raise ValueError("document ids must be bigint or string")
    (
        rows.repartitionByRange("key", "crc")
        .sortWithinPartitions("key", "crc")
        .select("key", "text")
        .mapInArrow(
            block_writer(path, end, dictionary, arrow), BLOCKS.format(id_type.simpleString())
        )
        .write.parquet(f"{folder}/blocks")
    )


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(row["bytes"]).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary in {folder} is damaged")
    return bytes(row["bytes"])


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, with ``start``: the ids of all documents before a block.

    The running sum is over the parts, one row each.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    parts = blocks.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("ids")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    return blocks.join(starts, "part").withColumn("start", F.col("base") + F.col("before"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a file set: doc_id, start, n_tokens, ids (32-bit bytes)."""
    return decoded(spark, folder, lambda raw: raw, pa.binary(), "ids binary")


def token_file_digest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, read back: doc_id, start, n_tokens, ids_crc32."""
    return decoded(spark, folder, zlib.crc32, pa.int64(), "ids_crc32 long")


def decoded(
    spark: SparkSession, folder: str, of: Callable, kind: pa.DataType, column: str
) -> DataFrame:
    dictionary = read_dictionary(spark, folder)
    digest, name = hashlib.sha256(dictionary).hexdigest(), column.split()[0]
    blocks = read_blocks(spark, folder)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=opened(dictionary)).decompress
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1)
                if block["dictionary"][0].as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                frames = memoryview(block["frames"][0].as_buffer())
                offsets = block["offsets"][0].as_py()
                counts = block["n_tokens"][0].values.to_numpy()
                starts = block["start"][0].as_py() + np.cumsum(counts, dtype=np.int64) - counts
                out = [
                    of(decompress(frames[a:b]))
                    for a, b in zip(offsets, offsets[1:], strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        block["doc_ids"][0].values,
                        pa.array(starts),
                        pa.array(counts.astype(np.int64)),
                        pa.array(out, kind),
                    ],
                    ["doc_id", "start", "n_tokens", name],
                )

    return blocks.select("dictionary", "doc_ids", "n_tokens", "offsets", "frames", "start").mapInArrow(
        documents, f"doc_id {id_type}, start long, n_tokens long, {column}"
    )


def read_documents(spark: SparkSession, folder: str, doc_ids: list) -> list[tuple]:
    """(doc_id, ids) of a few documents, by the offsets of their blocks alone."""
    dictionary = read_dictionary(spark, folder)
    decompress = zstandard.ZstdDecompressor(dict_data=opened(dictionary)).decompress
    wanted = spark.read.parquet(f"{folder}/blocks").select(
        F.arrays_zip(
            "doc_ids", F.slice("offsets", 1, F.size("doc_ids")), F.slice("offsets", 2, F.size("doc_ids"))
        ).alias("at"),
        "frames",
    )
    found = wanted.select(F.explode("at").alias("d"), "frames").select(
        F.col("d.doc_ids").alias("doc_id"),
        F.substring("frames", F.col("d.1") + 1, F.col("d.2") - F.col("d.1")).alias("frame"),
    )
    rows = found.where(F.col("doc_id").isin(doc_ids)).collect()
    return [(r.doc_id, np.frombuffer(decompress(bytes(r.frame)), "<u4").tolist()) for r in rows]


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/token-files-{uuid.uuid4().hex}"
