"""Integer intervals: coverage, gaps, islands, splicing and interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Integers that one task of ``contiguous_ranges`` looks at for a key.
SPAN = 1 << 16


def contiguous_ranges(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key, lo, hi`` of each run of consecutive integers. Nulls are ignored, repeats count once.

    Gaps and islands: the value less its rank is constant in a run. Runs are
    found within spans of ``SPAN`` integers, so a key with most of the rows is
    spread; only runs that touch a span's edge (two a span at the most) are then
    put together per key.
    """
    v = df.where(F.col(value).isNotNull()).select(key, F.col(value).cast("bigint").alias("v")).distinct().withColumn("s", F.floor(F.col("v") / SPAN))
    runs = v.withColumn("g", F.col("v") - F.row_number().over(Window.partitionBy(key, "s").orderBy("v")))
    runs = runs.groupBy(key, "s", "g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    edge = (F.col("lo") == F.col("s") * SPAN) | (F.col("hi") == (F.col("s") + 1) * SPAN - 1)
    w = Window.partitionBy(key).orderBy("lo")
    joined = runs.where(edge).withColumn("new", (~F.coalesce(F.lag("hi").over(w) + 1 == F.col("lo"), F.lit(False))).cast("int")).withColumn("n", F.sum("new").over(w))
    return runs.where(~edge).select(key, "lo", "hi").unionByName(joined.groupBy(key, "n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("n"))


def merged(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """``key, lo, hi``: intervals of integers united where they overlap or touch; none where a bound is null or the end before the start.

    Works on interval bounds, so the length of an interval costs nothing.
    """
    i = intervals.select(key, F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e")).where("s <= e")
    before = Window.partitionBy(key).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    new = F.when(F.col("s") > F.coalesce(F.max("e").over(before), F.lit(None)) + 1, 1).when(F.max("e").over(before).isNull(), 1).otherwise(0)
    group = F.sum("new").over(Window.partitionBy(key).orderBy("s", "e"))
    return i.withColumn("new", new).withColumn("g", group).groupBy(key, "g").agg(F.min("s").alias("lo"), F.max("e").alias("hi")).drop("g")


def clipped(intervals: DataFrame, start: str, end: str, low: Column, high: Column, offset: Column | int = 0) -> DataFrame:
    """Intervals moved by ``offset``, cut to ``low..high``, dropped where nothing is left."""
    off = offset if isinstance(offset, Column) else F.lit(offset)
    out = intervals.withColumn(start, F.greatest(F.col(start) + off, low)).withColumn(end, F.least(F.col(end) + off, high))
    return out.where(F.col(start) <= F.col(end))


def coverage(intervals: DataFrame, totals: DataFrame, key: str, start: str, end: str, total: str) -> DataFrame:
    """A4: per key of ``totals``: ``total_count, covered_count, missing_count, is_complete`` and the ``missing`` ranges in order.

    Intervals are cut to 1..total first; keys without intervals miss everything.
    """
    i = intervals.join(totals.select(key, F.col(total).alias("_n")), key)
    m = merged(clipped(i, start, end, F.lit(1), F.col("_n")), key, start, end)
    w = Window.partitionBy(key).orderBy("lo")
    gaps = m.withColumn("from", F.coalesce(F.lag("hi").over(w), F.lit(0)) + 1).withColumn("to", F.col("lo") - 1)
    per = gaps.groupBy(key).agg(
        F.sum(F.col("hi") - F.col("lo") + 1).alias("covered"), F.max("hi").alias("last"),
        F.sort_array(F.collect_list(F.when(F.col("from") <= F.col("to"), F.struct(F.col("from").alias("lo"), F.col("to").alias("hi"))))).alias("gaps"),
    )
    n, last = F.col(total).cast("bigint"), F.coalesce("last", F.lit(0)).cast("bigint")
    end_gap = F.when(last < n, F.array(F.struct((last + 1).alias("lo"), n.alias("hi")))).otherwise(F.array().cast("array<struct<lo:bigint,hi:bigint>>"))
    out = totals.select(key, total).join(per, key, "left")
    return out.select(
        key, n.alias("total_count"), F.coalesce("covered", F.lit(0)).alias("covered_count"), (n - F.coalesce("covered", F.lit(0))).alias("missing_count"),
        (n == F.coalesce("covered", F.lit(0))).alias("is_complete"), F.concat(F.coalesce("gaps", F.array().cast("array<struct<lo:bigint,hi:bigint>>")), end_gap).alias("missing"),
    )


def first_missing(covered: DataFrame, key: str) -> DataFrame:
    """The first missing range of each key that has one."""
    return covered.where(F.size("missing") > 0).select(key, F.col("missing")[0]["lo"].alias("lo"), F.col("missing")[0]["hi"].alias("hi"))


def spliced(old: DataFrame, new: DataFrame, start: str, end: str, low: int, high: int) -> DataFrame:
    """U4: ``old`` without the intervals that overlap ``low..high``, with those of ``new``, in order (nulls last)."""
    keep = old.where(~F.coalesce((F.col(start) <= high) & (F.col(end) >= low), F.lit(False)))
    return keep.unionByName(new).orderBy(F.asc_nulls_last(start), F.asc_nulls_last(end))


def members(intervals: DataFrame, points: DataFrame, keys: list[str], start: str, end: str, point: str) -> DataFrame:
    """Each interval joined to the points of the same keys inside it, bounds included.

    The interval is exploded to its integers and joined by equality, which
    Spark hashes; a range condition alone would make it compare all pairs.
    """
    i = intervals.where(F.col(start) <= F.col(end)).withColumn(point, F.explode(F.sequence(F.col(start).cast("int"), F.col(end).cast("int"))))
    return i.join(points, [*keys, point])
