"""The fact append as a stream over a landing folder.

Each micro-batch goes through the same load as a batch run: rows whose id the
table already has are left out, so a replayed batch adds nothing and the
delivery is exactly-once by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.session import stage_table
from starloom.sources.snapshot import ConflictError, SnapshotTable

#: how often a batch is loaded while others write the same table
ATTEMPTS = 5


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files under ``path``, as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def deliver(
    stream: DataFrame,
    table: SnapshotTable,
    load: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint: str,
    empty: DataFrame | None = None,
) -> StreamingQuery:
    """Append ``load(table, batch)`` for every micro-batch, then stop when idle.

    ``load`` gets the published table (``empty`` before the first batch) and the
    batch, and returns the rows to append.  Where another writer changed the table
    meanwhile, the batch is loaded again from what the table is then.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        # read by several steps of the load, so the source is read once
        arrived = stage_table(batch, f"batch{batch_id}")
        for attempt in range(ATTEMPTS):
            since = table.version()
            if not since and empty is None:
                raise ValueError("the table does not exist; pass its empty frame")
            try:
                table.append(load(table.read(since) if since else empty, arrived), since)
                return
            except ConflictError:
                if attempt + 1 == ATTEMPTS:
                    raise

    return (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
