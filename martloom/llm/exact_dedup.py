"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

The index is a folder of Parquet files, one row for each distinct text ever seen. A batch
is reduced to one candidate for each digest; those that a sort-merge anti join doesn't find
in the index are appended. What stays is then read from the index, so that the index alone
decides and a later batch is held against all earlier ones.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import own, unused, whole_text
from martloom.session import scratch_folder, write_stage

WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
ROWS_PER_BUCKET = 2_000_000


def squeezed(text: Column) -> Column:
    """The text without its ASCII white space; null as empty."""
    out = whole_text(text)
    for character in WHITE_SPACE:
        out = F.replace(out, F.lit(character))
    return out


def text_digest(text: Column) -> Column:
    return F.sha2(squeezed(text), 256)


def buckets_for(rows: int) -> int:
    """Buckets of an index that is to hold so many rows: a power of two, 16 at least."""
    return max(16, 1 << (max(rows, 1) // ROWS_PER_BUCKET).bit_length())


class DigestIndex:
    """One row per distinct text in ``folder``: digest, keep_id, points, row, batch.

    ``buckets`` holds for the life of the folder; opened again in another session, with the
    same number, the folder is the same index.
    """

    def __init__(self, spark: SparkSession, folder: str, id_type: T.DataType, buckets: int):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.name = "digest_index_" + hashlib.md5(self.folder.encode()).hexdigest()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, "
            f"keep_id {id_type.simpleString()}, points INT, row BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{self.folder}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, candidates: DataFrame) -> None:
        """Append the candidates, one per digest, whose digests the index doesn't hold."""
        known = self.table().select("digest").hint("merge")
        (
            candidates.join(known, "digest", "left_anti")
            .repartition(self.buckets, "digest")
            .select("digest", "keep_id", "points", "row", "batch")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .mode("append")
            .option("path", self.folder)
            .saveAsTable(self.name)
        )


def new_index(docs: DataFrame, key: str = "doc_id") -> DigestIndex:
    """An empty index in the shared folder, of a size for ``docs``."""
    spark = docs.sparkSession
    folder = f"{scratch_folder(spark)}/digest-index-{uuid.uuid4().hex}"
    return DigestIndex(spark, folder, docs.schema[key].dataType, buckets_for(docs.count()))


def add_batch(
    docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Add a batch to the index.

    Returns the batch's rows (key, digest, points, row) and, for each digest among them,
    its number of rows and what the index says of it. Of a batch's equal texts the one with
    the most code points goes to the index, then the smallest key, null last; of repeated
    rows, one. All copies of a text, however many, are reduced on the map side first.
    """
    batch = uuid.uuid4().hex
    rows = write_stage(
        docs.select(
            own(docs, key).alias("key"),
            text_digest(own(docs, text)).alias("digest"),
            F.char_length(whole_text(own(docs, text))).alias("points"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    groups = rows.groupBy("digest").agg(
        F.min(F.struct(-F.col("points"), F.col("key").isNull(), "key", "row")).alias("first"),
        F.count("*").alias("group_size"),
    )
    index.add(
        groups.select(
            "digest",
            F.col("first.key").alias("keep_id"),
            (-F.col("first.col1")).alias("points"),
            F.col("first.row").alias("row"),
            F.lit(batch).alias("batch"),
        )
    )
    # Written, so that both sides of the next join are shuffled and hot digests are split.
    verdicts = write_stage(
        groups.select("digest", "group_size")
        .join(index.table().hint("merge"), "digest")
        .withColumn("fresh", F.col("batch") == batch)
        .drop("batch")
        .withColumnsRenamed({"row": "keep_row", "points": "keep_points"}),
        "dedup-verdicts",
    )
    return rows, verdicts


def dedup_report(
    docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal to each other; rows with a null
    key are treated like others. ``keep_id`` may come from an earlier batch, then no row of
    this one is kept. Other columns are not looked at. An empty table gives no rows.
    """
    rows, verdicts = add_batch(docs, index, key, text)
    return rows.join(verdicts, "digest").select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        (F.col("fresh") & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(
    docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    One row for each text that the index didn't hold before.
    """
    _, verdicts = add_batch(docs, index, key, text)
    digest, points = unused(docs, "digest"), unused(docs, "points")
    wide = docs.withColumns(
        {
            digest: text_digest(own(docs, text)),
            points: F.char_length(whole_text(own(docs, text))),
        }
    )
    winners = verdicts.where("fresh")
    same = (
        (wide[digest] == winners["digest"])
        & (wide[points] == winners["keep_points"])
        & own(wide, key).eqNullSafe(winners["keep_id"])
    )
    stay = wide.join(winners.select("digest", "keep_points", "keep_id"), same, "left_semi")
    # Repeated rows of one key and text: reduced before and after a shuffle by the same keys.
    return stay.dropDuplicates([digest, points, key]).drop(digest, points)
