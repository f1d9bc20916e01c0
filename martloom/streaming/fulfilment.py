"""The order-fulfilment load fed by a stream of staging files.

The same incremental load, started by new files instead of a date window: each batch
of files not seen before is cleaned, enriched and upserted, and the stream stops when
nothing is left.  The stream's checkpoint takes the place of the high-water mark.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martloom.functions.gtin import CheckDigitFix, add_check_digit
from martloom.plans.fulfilment import run_fulfilment


def load_new_files(
    spark: SparkSession,
    staging_folder: str,
    staging_schema: StructType | str,
    checkpoint: str,
    mart_path: str,
    distribution_centres: DataFrame,
    items: DataFrame,
    calendar: DataFrame,
    clock: Callable[[], datetime],
    fix: CheckDigitFix = add_check_digit,
) -> None:
    """Upsert all staging files that arrived since the last call.

    A batch that is repeated after a failure upserts the same rows again, which
    changes nothing for rows with a full key.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        run_fulfilment(
            batch.sparkSession,
            mart_path,
            batch,
            distribution_centres,
            items,
            calendar,
            None,
            None,
            clock(),
            fix,
        )

    stream = spark.readStream.schema(staging_schema).parquet(staging_folder)
    query = (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
