"""Hash, date, number, array and map scalars as Column expressions: H, T, M and N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doc_id(source_file: Column, title: Column, n_chunks: Column) -> Column:
    """H1: a stable id from file, title and number of chunks; nulls count as empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (source_file, title, n_chunks)]
    return F.concat(F.lit("doc_"), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16))


def chunk_id(doc: Column, index: Column) -> Column:
    """H2."""
    return F.concat(doc, F.lit(":chunk_"), F.lpad(index.cast("string"), 5, "0"))


def signatures(rows: DataFrame, keys: list[str], content: Column) -> DataFrame:
    """H3, H4: ``keys, n, signature`` of each group's rows, whatever their order: SHA-1 over the hashes of 256 buckets of row hashes.

    Rows are spread by the first byte of their SHA-1, so a task holds a 256th of
    a group's hashes (a null key is a group as any other), and texts are never
    brought together.
    """
    h = rows.select(*keys, F.sha1(content).alias("_h")).withColumn("_b", F.substring("_h", 1, 2))
    part = h.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"), F.sha1(F.array_join(F.sort_array(F.collect_list("_h")), "")).alias("_s"))
    whole = F.sha1(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_s"))), lambda x: F.concat(x["_b"], x["_s"])), ""))
    return part.groupBy(*keys).agg(F.sum("_n").alias("n"), whole.alias("signature"))


def iso_time(text: Column, default: Column | None = None) -> Column:
    """ISO-8601 text as a timestamp, ``default`` (null) where it is none."""
    t = F.try_to_timestamp(text)
    return t if default is None else F.coalesce(t, default)


def year_week(day: Column) -> Column:
    """Year and week of the year, weeks from Monday, days before the first Monday in week 00."""
    return F.concat(F.date_format(day, "yyyy"), F.lit("-"), F.lpad(F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("string"), 2, "0"))


def months_between(first: Column, last: Column) -> Column:
    """The first days of the months from ``first`` to ``last``."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def older_than(moment: Column, now: Column, days: int) -> Column:
    """T4: false where the moment is unknown."""
    return F.coalesce(moment < now - F.expr(f"interval {days} days"), F.lit(False))


def min_max(values: Column) -> Column:
    """M1: an array scaled to 0..1; zeros where all values are equal."""
    # an array of one struct binds the bounds once; named inside the lambda they would be found anew for each value
    bounds = F.array(F.struct(F.array_min(values).alias("low"), F.array_max(values).alias("high")))
    scaled = F.transform(bounds, lambda b: F.transform(values, lambda x: F.when(b["high"] > b["low"], (x - b["low"]) / (b["high"] - b["low"])).otherwise(0.0)))
    return F.when(values.isNotNull(), scaled[0])


def layer_order(layer: Column, last: Column) -> Column:
    """M2: position of a layer on a scale to 10, 10 at the most; 0 where there is only one."""
    return F.when(last <= 0, F.lit(0.0)).otherwise(F.least(F.lit(10.0), 10.0 * (layer / last)))


def required_gb(parameters: Column) -> Column:
    """M3: space for three copies of two bytes each with a tenth to spare, at least 10; 0 where the size is unknown."""
    need = parameters * 2 * 3 / (1 << 30) * 1.1
    return F.when(parameters.isNull() | (parameters <= 0), F.lit(0.0)).otherwise(F.greatest(need, F.lit(10.0)))


def parameters_of_bytes(size: Column, bytes_each: int) -> Column:
    """M4."""
    return F.floor(size / bytes_each)


def pages(n: Column, per_page: int) -> Column:
    """M5: ceiling division."""
    return F.ceil(n / per_page).cast("bigint")


def round_half_even(x: Column) -> Column:
    """M6."""
    return F.bround(x, 0).cast("bigint")


def backoff(attempt: Column, base: float = 8.0) -> Column:
    """M8: doubling wait before the next attempt, without its random part."""
    return base * F.pow(F.lit(2.0), attempt - 1)


def cooldown(streak: Column, base: float = 15.0, most: float = 120.0) -> Column:
    """M8: wait after a streak of refusals, 0 without one."""
    return F.when(streak <= 0, 0.0).otherwise(F.least(F.lit(most), base * F.pow(F.lit(2.0), streak - 1)))


def context_targets(context: Column, reserved: int = 1024, low: float = 0.35, target: float = 0.6) -> Column:
    """M9: least, aimed at and most tokens of a window within a context."""
    room = F.greatest(F.lit(256), context - reserved)
    return F.struct(F.floor(room * low).cast("int").alias("least"), F.floor(room * target).cast("int").alias("target"), room.cast("int").alias("most"))


def resized_window(size: Column, used: Column, target: Column, least: int = 2, most: int = 60) -> Column:
    """M9: the window scaled by how much of the target was used, half to even, within limits."""
    return F.greatest(F.lit(least), F.least(F.lit(most), F.bround(size * target / F.greatest(used, F.lit(1)), 0))).cast("int")


def distinct_in_order(items: Column) -> Column:
    """Trimmed, without blanks, each once, in order."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: F.btrim(x)), lambda x: x.isNotNull() & (x != "")))


def overlay(base: Column, over: Column) -> Column:
    """A map in which entries of ``over`` replace those of ``base``."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(over), k)), over)


def first_key(values: Column, *keys: str) -> Column:
    """The value of the first key that is there."""
    return F.coalesce(*(values[k] for k in keys))


def append_once(items: Column, item: Column) -> Column:
    """N7."""
    return F.array_union(F.coalesce(items, F.array().cast("array<string>")), F.array(item))


def resume_after(items: Column, last: Column) -> Column:
    """What follows ``last``; all of it where ``last`` is not there."""
    at = F.coalesce(F.array_position(items, last), F.lit(0)).cast("int")
    return F.slice(items, at + 1, F.size(items))


def whole_range(first: Column, last: Column) -> Column:
    """The whole numbers from ``first`` to ``last``, both included; empty where ``last`` is smaller, null for null."""
    return F.when(first <= last, F.sequence(first, last)).when(first > last, F.slice(F.array(first), 1, 0))
