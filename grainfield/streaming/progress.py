"""The same transforms over a stream: files arrive a few at a time, late events close their windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batches(spark: SparkSession, path: str, schema: str, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files: int = 50):
    """Apply a batch transform to each `files` new Parquet files of a folder; a restart goes on from the checkpoint."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return stream.writeStream.foreachBatch(lambda rows, n: transform(rows).write.mode("overwrite").parquet(f"{out}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Throughput by window and type; events later than `late` are dropped by the watermark on a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), (F.round(F.sum("value") * 1e4) / 1e4).alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
