"""Sinks: stage tables as Parquet, release tables as CSV (gzip) and JSON. All overwrite, so a rerun is idempotent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """A table between stages."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_release(df: DataFrame, path: str, columns: Sequence[str], gzip: bool = False) -> None:
    """The allowed columns that exist, in their order, as CSV with a header; one file per partition, so large tables stay distributed."""
    have = [c for c in columns if c in df.columns]
    writer = df.select(*have).write.mode("overwrite").option("header", True).option("escape", '"')
    (writer.option("compression", "gzip") if gzip else writer).csv(path)


def search_index(df: DataFrame, title: str, sub: str, url: str, kind: str) -> DataFrame:
    """(json): one line {t, s, u, k} per entry of a search index."""
    return df.select(F.to_json(F.struct(F.col(title).alias("t"), F.col(sub).alias("s"), F.col(url).alias("u"), F.lit(kind).alias("k"))).alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
