"""Structured Streaming: event decoding, per-batch scoring and daily windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from demandloom.streaming.series import keyed_state

# Default trigger and lateness of the sales stream.
TRIGGER = "10 seconds"
LATENESS = "1 hour"


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """File source with an explicit schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_score(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Score every micro-batch and write it once to ``{output}/batch_id=N``.

    A replayed batch overwrites its own folder, so the sink holds each batch
    once.  A batch is evaluated once and kept until it is written; empty
    batches are skipped.  Scores that need earlier rows of a series take a
    stream from ``series_features``.  ``trigger=None`` takes all available data
    and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                scored = score(batch).withColumn("processing_time", F.current_timestamp())
                scored.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    with keyed_state(stream.sparkSession):
        return writer.start()


def daily_sales(
    stream: DataFrame, keys: Sequence[str] = ("store_id",), time: str = "timestamp", value: str = "sales", lateness: str = LATENESS
) -> DataFrame:
    """Sum per key and day with a watermark; the same function serves batch and stream.

    In append mode a day is emitted when the watermark passes its end.
    """
    late = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return late.groupBy(*keys, F.window(time, "1 day").alias("_w")).agg(F.sum(value).alias(value)).select(
        *keys, F.to_date("_w.start").alias("date"), value
    )


def dedupe_events(stream: DataFrame, ids: Sequence[str] = ("event_id",), time: str = "timestamp", lateness: str = LATENESS) -> DataFrame:
    """Drop repeated ids that arrive within the lateness."""
    late = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return late.dropDuplicatesWithinWatermark(list(ids)) if stream.isStreaming else late.dropDuplicates(list(ids))


def run_to_parquet(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Drain what is available into parquet (append) and wait."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("path", output)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
    with keyed_state(stream.sparkSession):
        query = writer.start()
    query.awaitTermination()
