"""Incremental merges, written as joins and unions; the caller writes the result to a new place and switches over."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _last(batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    return batch.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def merge_append(target: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First value wins: rows of new keys are added, one for each."""
    return target.unionByName(_last(batch, keys, order).join(target.select(*keys), keys, "left_anti"))


def merge_replace(target: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Last value wins: rows of the batch replace those of their keys."""
    fresh = _last(batch, keys, order)
    return target.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def merge_rules(target: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """Full join with a rule for each column: new (else old), keep (else new), greatest, least, sticky (or of both).

    Rows of a key that the batch has several times are first merged by the same rules, new and keep in order of values: the greatest counts as new,
    the least is kept. Keys of target are unique.
    """
    within = {"new": F.max, "keep": F.min, "greatest": F.max, "least": F.min, "sticky": F.bool_or}
    batch = batch.groupBy(*keys).agg(*(within[r](c).alias(c) for c, r in rules.items()))
    t, b = target.select(*keys, *(F.col(c).alias(f"_t_{c}") for c in rules)), batch.select(*keys, *(F.col(c).alias(f"_b_{c}") for c in rules))

    def one(c: str, rule: str):
        old, new = F.col(f"_t_{c}"), F.col(f"_b_{c}")
        return {"new": F.coalesce(new, old), "keep": F.coalesce(old, new), "greatest": F.greatest(old, new), "least": F.least(old, new)}[rule] if rule != "sticky" else F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False))

    return t.join(b, keys, "full").select(*keys, *(one(c, r).alias(c) for c, r in rules.items()))


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways by one aggregate: rows with how often they are more in a (positive) or b (negative)."""
    both = a.withColumn("_w", F.lit(1)).unionByName(b.withColumn("_w", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("_w").alias("excess")).where("excess <> 0")


def prune(df: DataFrame, ts: str, cutoff, keep=None) -> DataFrame:
    old = F.col(ts) < cutoff
    return df.where(~old | keep if keep is not None else ~old)
