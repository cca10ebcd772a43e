"""Structured Streaming forms of the incremental steps: new files once, messages once, counts per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_files(spark: SparkSession, path: str, schema: T.StructType, per_trigger: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def messages_once(stream: DataFrame, keys: list[str], at: str = "loaded_at", late: str = "30 days") -> DataFrame:
    """Each message once; copies are recognised while they are at most ``late`` behind the newest."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def counts_by_window(stream: DataFrame, at: str, kind: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows per window and kind, late rows included up to the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, then stop: for scheduled runs."""
    df.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
