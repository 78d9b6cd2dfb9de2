"""Starting streams: checkpoints, triggers and progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def start(
    df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None, path: str | None = None,
    mode: str = "append", interval: str | None = None, name: str | None = None,
) -> StreamingQuery:
    """Start a query into ``foreachBatch`` (``write``) or parquet files (``path``).

    Without an interval it handles what is there and stops. The checkpoint folder makes a restart continue
    where the last run ended; ``write`` must be idempotent per batch id, as the batch writers are.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    if write is not None:
        return writer.foreachBatch(write).start()
    return writer.format("parquet").start(path)


def run(df: DataFrame, checkpoint: str, **options) -> StreamingQuery:
    """Run to the end of the available input."""
    query = start(df, checkpoint, **options)
    query.awaitTermination()
    return query


def with_fresh_side(
    side: Callable[[SparkSession], DataFrame], join: Callable[[DataFrame, DataFrame], DataFrame], write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """J4, S4 for ``foreachBatch``: joins each micro-batch to a side that is read anew for it.

    A static frame in a streaming plan keeps the files that it found when it was made; here a changed label shows from
    the next batch on, which is what a lookup as of processing time sees.
    """
    return lambda df, batch_id: write(join(df, side(df.sparkSession)), batch_id)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped because their window was closed."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in dict(p).get("stateOperators", [])
    )
