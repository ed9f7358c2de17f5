"""Comparison of vectors: J6, U2, M1, A10, A11."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compared(left: DataFrame, right: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, mad, msd, corr``: mean absolute and mean squared difference and correlation of the vectors of equal key and length, after min-max scaling; others are left out.

    The values are exploded after the join, whose partitioning by key the
    aggregation takes over, so that it needs no shuffle and runs in generated
    code. Correlation is null where one vector is constant.
    """
    doubles = F.transform(vector, lambda v: v.cast("double"))
    j = left.select(key, doubles.alias("a")).join(right.select(key, doubles.alias("b")), key).where(F.size("a") == F.size("b"))
    for c in "ab":
        j = j.withColumn(f"{c}0", F.array_min(c)).withColumn(f"{c}1", F.array_max(c) - F.array_min(c))
    e = j.select(key, "a0", "a1", "b0", "b1", F.explode(F.arrays_zip("a", "b")).alias("p"))
    x, y = (F.when(F.col(f"{c}1") > 0, (F.col(f"p.{c}") - F.col(f"{c}0")) / F.col(f"{c}1")).otherwise(0.0).alias(n) for c, n in (("a", "x"), ("b", "y")))
    e = e.select(key, x, y, ((F.col("a1") > 0) & (F.col("b1") > 0)).alias("vary"))
    d = F.col("x") - F.col("y")
    return e.groupBy(key).agg(F.avg(F.abs(d)).alias("mad"), F.avg(d * d).alias("msd"), F.when(F.first("vary"), F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))).alias("corr"))


def sensitive(metrics: DataFrame, mad: float = 0.002, corr: float = 0.95) -> DataFrame:
    """A11."""
    return metrics.where((F.col("mad") > mad) | (F.col("corr") < corr))


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only: ``key, side`` (``missing`` on the right, ``extra`` on the right)."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def same_keys(left: DataFrame, right: DataFrame, key: str) -> bool:
    """A single answer; stops at the first difference."""
    return key_difference(left, right, key).isEmpty()
