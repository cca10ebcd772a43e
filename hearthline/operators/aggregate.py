"""Longitudinal aggregates: shares per year, cross-tabs, rolling means, bins, coverage, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_by_year(df: DataFrame, unit: str, year: str, flags: Sequence[str]) -> DataFrame:
    """Per year the number of units and the share of units with any flagged row. Two levels: unit (its first year, any), then year; units without a year are left out."""
    per = df.where(F.col(unit).isNotNull()).groupBy(unit).agg(F.min(year).alias("_y"), *[F.bool_or(f).alias(f) for f in flags])
    return per.where("_y IS NOT NULL").groupBy(F.col("_y").alias(year)).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(f).cast("int")).alias(f"share_{f}") for f in flags])


def cross_tab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``column``'s named values per ``row``, zero where there are none; values are given, so one pass is enough."""
    return df.where(F.col(row).isNotNull()).groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def rolling_mean(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Mean of a row and its neighbours by order, nulls skipped. For series of one row per period: their rows are few."""
    return df.withColumn(name, F.avg(value).over(Window.orderBy(order).rowsBetween(-1, 1)))


def binned(c: Column, edges: Sequence[int]) -> Column:
    """Label of the half-open bin that holds a count: "0", "1-4", ..., "20+"."""
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for lo, hi in zip(edges, edges[1:]):
        out = out.when((c >= lo) & (c < hi), F.lit(str(lo) if hi == lo + 1 else f"{lo}-{hi - 1}"))
    return out.when(c >= edges[-1], F.lit(f"{edges[-1]}+"))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows per key by a total order; Spark limits groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def coverage(df: DataFrame, counted: dict[str, Column], distinct: dict[str, str]) -> DataFrame:
    """One row: the number of rows, conditional counts, distinct counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(k) for k, c in counted.items()], *[F.count_distinct(c).alias(k) for k, c in distinct.items()])


def metrics(stage: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(stage, metric, key, value): rows, non-null counts and value distributions, for a report kept as data."""
    base = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in columns])
    wide = base.select(F.explode(F.map_from_arrays(F.array(F.lit("rows"), *[F.lit(f"filled:{c}") for c in columns]), F.array("rows", *columns))).alias("metric", "value"))
    out = wide.select(F.lit(stage).alias("stage"), "metric", F.lit(None).cast("string").alias("key"), "value")
    for c in columns:
        out = out.unionByName(df.groupBy(F.col(c).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("value")).select(F.lit(stage).alias("stage"), F.lit(f"values:{c}").alias("metric"), "key", "value"))
    return out
