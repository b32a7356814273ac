"""The usage job as a stream over the feed folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketlake.plans.usage_rollup import (
    UsagePaths,
    refresh_dates,
    stored_feed_schema,
    touched_dates,
)
from marketlake.schemas import AGENT_TOOL_CALLS, WATCHLIST_MUTATIONS


def start_usage_stream(
    spark: SparkSession, paths: UsagePaths, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Process all feed files that arrived since the last run, then stop.

    A micro-batch only says which event dates it touches; those are recomputed from the
    feed. Late events need no watermark, no state is kept between batches, and a batch
    that is delivered twice writes the same partitions again.
    """
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}

    def arriving(path: str, table) -> DataFrame:
        stream = spark.readStream.schema(stored_feed_schema(table)).options(**options)
        return stream.parquet(path).select("event_date")

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        failed = {k: v for k, v in refresh_dates(spark, paths, touched_dates(batch)).items() if isinstance(v, str)}
        if failed:
            raise RuntimeError(f"rollups failed: {failed}")

    touched = arriving(paths.calls, AGENT_TOOL_CALLS).unionByName(arriving(paths.mutations, WATCHLIST_MUTATIONS))
    return (
        touched.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
