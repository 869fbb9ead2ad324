"""Append, backfill and refresh as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quern.functions.frames import Feature
from quern.operators.backfill import backfill
from quern.operators.views import refresh_view
from quern.sources.store import TableStore


def run_cycle(
    store: TableStore,
    stream: DataFrame,
    table: str,
    features: list[str],
    registry: dict[str, Feature],
    views: list[str],
    checkpoint: str,
) -> StreamingQuery:
    """Drain a stream of new rows into a stored table and bring its views up to date.

    Per micro-batch: append the rows, fill the derived columns of rows that lack
    them, refresh the views. A batch that is delivered again after a failure is
    recognized by its id and appended once; backfill and refresh only add what is
    missing, so repeating them is harmless. Rows whose key is stored already are
    left out.
    """
    key = store.key(table)

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        stored = store.read_base(table).select(key)
        fresh = rows.dropDuplicates([key]).join(stored, key, "left_anti")
        store.append(table, fresh, batch=f"{checkpoint}:{batch_id}")
        backfill(store, table, features, registry)
        for view in views:
            refresh_view(store, view)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_stream(spark, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files under a path as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)

