"""The daily cycle as a stream over the landing folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stopgrid.operators.merge import ORIGIN, file_place, upsert_table, with_row


def ingest_available(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    keys: Sequence[str],
    partitions: Sequence[str],
    order: Sequence[str] = (),
    files_per_batch: int | None = None,
) -> None:
    """Upsert the landing files not seen before, then stop.

    The checkpoint remembers finished files, so a run without new files does
    nothing. Of several rows of a key the last by `order` is taken, then that of the
    later file and row, so a batch that is repeated after a failure upserts the same
    rows again, which changes nothing.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            upsert_table(batch.sparkSession, table, with_row(batch), keys, partitions, [*order, ORIGIN])

    query = (
        reader.parquet(landing)
        .withColumn(ORIGIN, file_place())
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .start()
    )
    query.awaitTermination()
