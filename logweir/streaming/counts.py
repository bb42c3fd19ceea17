"""Windowed counts over arriving logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

Sink = Callable[[DataFrame, int], None]


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Log files as they arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def hourly_counts(
    logs: DataFrame,
    keys: Sequence[str] = (),
    time_column: str = "itime",
    width: str = "1 hour",
    late: str = "2 days",
) -> DataFrame:
    """Rows per window and key.  State holds one counter per open window and key; it is
    freed when the watermark passes the window's end.  Rows later than ``late`` are
    dropped; ``rollup.Rollup`` counts them.

    Watermarks need zoned time, so naive event time is read in the session's zone and
    the window start is given back naive.
    """
    timed = logs.withColumn("_at", F.col(time_column).cast("timestamp")).withWatermark("_at", late)
    counted = timed.groupBy(F.window("_at", width).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("hits"))
    return counted.select(F.col("_w.start").cast("timestamp_ntz").alias("bucket"), *keys, "hits")


def write_once(
    counts: DataFrame, checkpoint: str, mode: str = "append", table: str | None = None, path: str | None = None
) -> StreamingQuery:
    """Process everything that has arrived and stop: to memory for tests, else to files."""
    writer = counts.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if path is not None:
        return writer.format("parquet").start(path)
    return writer.format("memory").queryName(table).start()


def _each_batch(counts: DataFrame, checkpoint: str, mode: str, sink: Sink) -> StreamingQuery:
    return (
        counts.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )


def upsert_counts(counts: DataFrame, checkpoint: str, sink: Sink) -> StreamingQuery:
    """Changed windows to ``sink(batch, batch_id)``, which must be idempotent per batch."""
    return _each_batch(counts, checkpoint, "update", sink)


def upsert_files(counts: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    """Changed windows as files of their batch under ``path``; a repeated batch replaces its own."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return upsert_counts(counts, checkpoint, keep)


def latest_counts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last state of each window and key among the batches of ``upsert_files``.

    A counter only grows, so its largest value is its last.
    """
    return spark.read.parquet(path).groupBy("bucket", *keys).agg(F.max("hits").alias("hits"))
