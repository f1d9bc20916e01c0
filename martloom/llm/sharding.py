"""Rendezvous hashing of stable keys over weighted shards.

Every shard draws a number from a key; the shard with the least cost takes it. A shard that
is added takes keys only into itself, and one that is removed gives up only its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import own, whole_text
from martloom.session import write_stage

#: A row costs its text and so many bytes more.
ROW_BYTES = 16
#: Rows copied at once where one row stands for many repeated ones.
COPIES = 4096


def drawn(key: Column, shard: Column) -> Column:
    """A uniform number above 0, at most 1, with 52 bits, for a key and a shard."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 1) / F.lit(float(1 << 52))


def bids(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """The least (cost, shard) among shards ``first``, ``first`` + 1, ... of these weights.

    The costs of a key are exponential variables with the weights as rates, so that a shard
    takes keys in proportion to its weight. Equal costs: the smaller number.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, and there must be one at least")
    return F.array_min(
        F.transform(
            F.array(*[F.lit(float(w)) for w in weights]),
            lambda w, i: F.struct(
                (-F.ln(drawn(key, i + first)) / w).alias("cost"), (i + first).alias("shard")
            ),
        )
    )


def stable_key(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    added: Sequence[float] = (),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard once shards with the weights ``added`` stand beside the
    others (null if none). A null key is hashed as an empty one, a null text has no bytes.
    ``slot`` numbers the rows of a shard from 0 without gaps, in the order of a digest of
    key, size and checksum; repeated rows take neighbouring slots.

    No shard is numbered in one task: rows are ordered inside the 4096 cells that the first
    three digits of the digest give, and a running sum of the cells' counts, a table whose
    size is fixed by the number of shards, tells where each cell begins.
    """
    content = whole_text(own(docs, text))
    rows = (
        docs.select(
            own(docs, key).alias("key"),
            (F.octet_length(content).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(content).alias("text_crc32"),
        )
        .groupBy("key", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
    )
    name = stable_key(F.col("key"))
    rows = rows.withColumn("best", bids(name, weights))
    grown = F.least("best", bids(name, added, len(weights)))["shard"] if added else F.lit(None)
    rows = write_stage(
        rows.select(
            "key",
            "size",
            "text_crc32",
            "copies",
            F.col("best.shard").alias("shard"),
            grown.cast("int").alias("grown_shard"),
            F.md5(F.concat_ws(":", name, "size", "text_crc32")).alias("place"),
        ).withColumn("cell", F.substring("place", 1, 3)),
        "sharded",
    )
    cells = (
        rows.groupBy("shard", "cell")
        .agg(F.sum("copies").alias("held"))
        .withColumn(
            "before",
            F.sum("held").over(Window.partitionBy("shard").orderBy("cell")) - F.col("held"),
        )
        .drop("held")
    )
    within = Window.partitionBy("shard", "cell").orderBy("place", "key", "size", "text_crc32")
    begun = rows.withColumn("inside", F.sum("copies").over(within) - F.col("copies")).join(
        cells, ["shard", "cell"]
    )
    last = F.col("copies") - 1
    return (
        begun.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES))))
        .withColumn(
            "copy", F.explode(F.sequence("block", F.least(last, F.col("block") + COPIES - 1)))
        )
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("before") + F.col("inside") + F.col("copy")).alias("slot"),
            "grown_shard",
        )
    )
