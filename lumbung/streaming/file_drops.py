"""The append-new load fed by files as they arrive (L5 as a stream).

Each run handles the files dropped since the last one and ends.  A micro batch
is one load batch of the store, with an id that depends on its number only: if
it is run again after a failure it replaces its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lumbung.operators.dedup import dedup_by_key
from lumbung.sources.stores import ParquetStore


def append_file_drops(
    spark: SparkSession,
    folder: str,
    format: str,
    schema: str,
    store: ParquetStore,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    **options: str,
) -> None:
    """Append the rows of new files in ``folder`` whose key is new."""

    def load(batch: DataFrame, number: int) -> None:
        rows = dedup_by_key(batch, keys)
        store.append_new(
            table, rows, keys, f"STREAM-{number:012d}", schema, count_input=False
        )

    query = (
        spark.readStream.format(format)
        .schema(schema)
        .options(**options)
        .load(folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
