"""Quality checks, profiles and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateClosed(RuntimeError):
    """A mart may not be published; the message names the blocking keys."""


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def check_unit_interval(df: DataFrame, cols: list[str]) -> DataFrame:
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.coalesce((F.col(c) < 0) | (F.col(c) > 1), F.lit(False))
    return df.where(bad)


def check_ohlc(df: DataFrame) -> DataFrame:
    return df.where("low_price > least(open_price, close_price, high_price) OR high_price < greatest(open_price, close_price, low_price)")


def check_axis(df: DataFrame, key: list[str], axis: str) -> DataFrame:
    """Keys whose axis is not 0, 1, 2, ... without a hole or a copy."""
    found = df.groupBy(*key).agg(F.min(axis).alias("lo"), F.max(axis).alias("hi"), F.count("*").alias("n"), F.count_distinct(axis).alias("d"))
    return found.where("lo <> 0 OR hi <> n - 1 OR d <> n")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls, distinct values, least and greatest of each column in one pass, a row for each column."""
    aggs = [e for c in cols for e in (F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), F.count_distinct(c).alias(f"{c}__distinct"), F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max"))]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    each = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__distinct").alias("distinct_values"), F.col(f"{c}__min").alias("min_text"), F.col(f"{c}__max").alias("max_text")) for c in cols))
    return one.select("rows", F.explode(each).alias("s")).select("rows", "s.*")


def quality_row(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: how often each check fails, and the comma-joined names of those that do (null: none)."""
    counts = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()))
    return counts.withColumn("blocking_keys", F.nullif(F.concat_ws(",", *(F.when(F.col(k) > 0, F.lit(k)) for k in checks)), F.lit("")))


def gate(mart: DataFrame, quality: DataFrame) -> DataFrame:
    """mart, unless the quality row names blocking keys."""
    blocked = quality.select("blocking_keys").first()[0]
    if blocked:
        raise GateClosed(blocked)
    return mart
