"""Ordered scans that no large key can stall: running values along an order, in two passes.

Keys of up to SEGMENT_ROWS rows are ordinary windows. The rows of larger keys are dealt to MOST_SEGMENTS segments at most, by ranges of (key, order),
written once, and scanned within their segments; one row a segment then carries what came before it (or comes after it) over, and
each segment is joined to its carry. No task holds a large key whole, and the results are those of one window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.sources.snapshots import shared_root

#: Rows of a key beyond which it is cut in segments of about so many.
SEGMENT_ROWS = 4_000_000
#: Keys that are cut at once: the largest ones. With more, every other key has less than 1/MOST_LARGE of all rows.
MOST_LARGE = 1024
#: Segments of a scan, each a task and a file; with more rows, segments grow instead.
MOST_SEGMENTS = 1024
#: For scan: the large keys are not known yet.
COUNT = "count"


@dataclass(frozen=True)
class Scan:
    """A running value. kind: last (the last one that is not null up to a row), next (the first one that is not null from a row on),
    sum, max or min up to a row. own: whether the row itself counts."""

    kind: str
    value: Column
    own: bool = True

    def within(self, keys: list[str], order: list[str]) -> Column:
        # next is last in the opposite order: a frame that ends with the key is worked out anew for every row
        back = self.kind == "next"
        by = [F.col(c).desc_nulls_last() if back else F.col(c).asc_nulls_first() for c in order]
        frame = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0 if self.own else -1)
        if self.kind in ("last", "next"):
            return F.last(self.value, ignorenulls=True).over(frame)
        return getattr(F, self.kind)(self.value).over(frame)

    def summary(self, order: list[str]) -> Column:
        if self.kind in ("last", "next"):
            at = F.when(self.value.isNotNull(), F.struct(*order))
            return (F.max_by if self.kind == "last" else F.min_by)(self.value, at)
        return getattr(F, self.kind)(self.value)

    def carried(self, name: str) -> Column:
        return Scan(self.kind, F.col(name), own=False).within(["_large"], ["_segment"])

    def joined(self, within: Column, carry: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(within + carry, within, carry)
        return {"last": F.coalesce, "next": F.coalesce, "max": F.greatest, "min": F.least}[self.kind](within, carry)


def last_seen(value: Column, own: bool = True) -> Scan:
    return Scan("last", value, own)


def next_seen(value: Column, own: bool = True) -> Scan:
    return Scan("next", value, own)


def large_keys(df: DataFrame, keys: list[str], rows: int) -> DataFrame | None:
    """(keys, _large, _rows): the largest keys of more than rows rows, numbered, at most MOST_LARGE of them; None if there is none."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > rows)
    found = counts.orderBy(F.desc("_rows")).limit(MOST_LARGE).collect()
    if not found:
        return None
    return df.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(found)], StructType([*counts.schema, StructField("_large", IntegerType())]))


def _numbered(df: DataFrame, keys: list[str], large: DataFrame) -> DataFrame:
    """df with _large, the number of a row's key among the large ones; nulls are a key like any other."""
    other = large.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), "_large")
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(F.broadcast(other), on, "left").drop(*(f"_key{i}" for i in range(len(keys))))


def segments(df: DataFrame, keys: list[str], order: list[str], large: DataFrame, rows: int) -> DataFrame:
    """The rows of large keys with _large and _segment, ranges of (key, order) of about rows rows, in order. They are written once, so
    that a row stays in its segment when a task is run again."""
    spark = df.sparkSession
    total = large.agg(F.sum("_rows")).first()[0]
    dealt = _numbered(df, keys, large).where("_large IS NOT NULL").repartitionByRange(min(-(-total // rows) + 1, MOST_SEGMENTS), "_large", *order)
    place = shared_root(spark, "scan")
    dealt.withColumn("_segment", F.spark_partition_id()).write.option("compression", "zstd").parquet(place)
    return spark.read.parquet(place)


def scan(df: DataFrame, keys: list[str], order: list[str], scans: dict[str, Scan], rows: int = SEGMENT_ROWS, large: DataFrame | str | None = COUNT) -> DataFrame:
    """df with a column for each scan, along order (ascending, nulls first) within keys; a null key is a key like any other.

    Rows that tie in order may stand in any sequence, as in a window. Counting the keys runs a job at once, unless large has what large_keys
    gave for the same rows. Columns of df named like a scan are replaced. An empty table gives an empty table.
    """
    large = large_keys(df, keys, rows) if isinstance(large, str) else large
    if large is None:
        return df.withColumns({name: s.within(keys, order) for name, s in scans.items()})
    cut = segments(df, keys, order, large, rows)
    names = {name: f"_carry{i}" for i, name in enumerate(scans)}
    carries = cut.groupBy("_large", "_segment").agg(*(s.summary(order).alias(names[name]) for name, s in scans.items()))
    carries = carries.select("_large", "_segment", *(s.carried(names[name]).alias(names[name]) for name, s in scans.items()))
    found = cut.withColumns({f"{names[name]}w": s.within(["_large", "_segment"], order) for name, s in scans.items()}).join(carries, ["_large", "_segment"])
    found = found.withColumns({name: s.joined(F.col(f"{names[name]}w"), F.col(names[name])) for name, s in scans.items()})
    found = found.drop("_large", "_segment", *names.values(), *(f"{n}w" for n in names.values()))
    small = _numbered(df, keys, large).where("_large IS NULL").drop("_large").withColumns({name: s.within(keys, order) for name, s in scans.items()})
    return small.unionByName(found)
