"""Which rows repeat the text of another one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import salted_join


def with_copies(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``rows`` with ``again``: whether a row of a lower ``key`` has the same text (by its SHA-256; a null text repeats none).

    Only hashes and keys are shuffled: the lowest key of each hash is a partial
    minimum, the other keys are those that are none of these, and come back to
    the rows by a measured join. Rows repeated with their key are not told apart.
    """
    hashes = rows.where(F.col(text).isNotNull()).select(key, F.unhex(F.sha2(text, 256)).alias("h"))
    first = hashes.groupBy("h").agg(F.min(key).alias(key)).select(key)
    again = hashes.select(key).join(first, key, "left_anti").distinct().withColumn("again", F.lit(True))
    return salted_join(rows, again, [key], "left").withColumn("again", F.coalesce("again", F.lit(False)))


def with_repeats(rows: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """``rows`` with ``again``: positions of the ``texts`` columns whose text a row of a lower ``key`` has in the same column, null for none.

    As ``with_copies``, for each of several columns by itself.
    """
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.unhex(F.sha2(t, 256)).alias("h")) for c, t in enumerate(texts))))
    hashes = rows.select(key, each.alias("x")).select(key, "x.c", "x.h").where("h is not null")
    first = hashes.groupBy("c", "h").agg(F.min(key).alias(key)).select(key, "c")
    again = hashes.select(key, "c").join(first, [key, "c"], "left_anti").groupBy(key).agg(F.collect_set("c").alias("again"))
    return salted_join(rows, again, [key], "left")
