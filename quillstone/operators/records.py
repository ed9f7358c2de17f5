"""Retrieval records from blocks and chunks: J5, W1, W2, A5, P3, P4, F14, F19, G13."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.scalars import chunk_id, distinct_in_order, doc_id
from quillstone.functions.text import token_count
from quillstone.operators.intervals import members


def keep_permissive(flag: Column) -> Column:
    """false only for what plainly says so; missing and unknown values keep."""
    return ~F.coalesce(F.lower(F.btrim(flag.cast("string"))).isin("false", "no", "0", "n"), F.lit(False))


def keep_strict(flag: Column) -> Column:
    """true only for what plainly says so; missing values keep, unknown ones don't."""
    return F.coalesce(F.lower(F.btrim(flag.cast("string"))).isin("true", "yes", "1", "y"), F.lit(True))


def first_filled(*columns: Column) -> Column:
    """The first column that is not blank, trimmed."""
    return F.coalesce(*(F.nullif(F.btrim(c), F.lit("")) for c in columns))


def first_filled_in_group(columns: list[str], order: str) -> Column:
    """P3 (aggregate): row by row, then column by column, the first value that is not blank."""
    v = first_filled(*map(F.col, columns))
    return F.min_by(v, F.when(v.isNotNull(), F.col(order)))


def numbered(df: DataFrame, key: list[str], order: list[str], index: str = "chunk_index", count: str = "chunk_count") -> DataFrame:
    """Positions from 1 and the number of rows per key."""
    return df.withColumn(index, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).withColumn(count, F.count(F.lit(1)).over(Window.partitionBy(*key)).cast("int"))


def linked(df: DataFrame, key: list[str], order: list[str], id_: str = "chunk_id") -> DataFrame:
    """Ids of the rows before and after, empty at the ends."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("prev_chunk_id", F.coalesce(F.lag(id_).over(w), F.lit(""))).withColumn("next_chunk_id", F.coalesce(F.lead(id_).over(w), F.lit("")))


def page_bounds() -> tuple[Column, Column]:
    """A5 (aggregates): first and last page, whatever is no number ignored; either stands in for the other."""
    start = F.coalesce(F.col("start_page").try_cast("int"), F.col("end_page").try_cast("int"))
    end = F.coalesce(F.col("end_page").try_cast("int"), F.col("start_page").try_cast("int"))
    return F.min(start).alias("page_start"), F.max(end).alias("page_end")


def build_records(blocks: DataFrame, chunks: DataFrame, key: str = "source_file") -> DataFrame:
    """Retrieval records from blocks ``key, start, end, question, summary, alt_questions, is_content`` over chunks.

    Blocks that are no content are dropped; the rest are numbered and cut to
    the chunks there are; their chunks (J4) are joined by blank lines in order
    and give title and page bounds; ids and links follow. A block without
    chunks gives a record without text.
    """
    totals = chunks.groupBy(key).agg(F.max("chunk_index").alias("source_chunk_total"), first_filled_in_group(["source_title"], "chunk_index").alias("source_title"))
    kept = blocks.where(keep_permissive(F.col("is_content"))).join(totals, key)
    kept = numbered(kept, [key], ["start", "end"])
    kept = kept.withColumn("chunk_start", F.greatest(F.lit(1), F.least("start", "source_chunk_total"))).withColumn("chunk_end", F.greatest("chunk_start", F.least("end", "source_chunk_total")))
    body = members(kept.select(key, F.col("chunk_index").alias("block"), "chunk_start", "chunk_end"), chunks.select(key, "chunk_index", "output", "start_page", "end_page"), [key], "chunk_start", "chunk_end", "chunk_index")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_index", "output"))), lambda x: x["output"]), "\n\n")
    texts = body.groupBy(key, "block").agg(text.alias("output"), *page_bounds())
    out = kept.join(texts.withColumnRenamed("block", "chunk_index"), [key, "chunk_index"], "left")
    questions = distinct_in_order(F.col("alt_questions"))
    out = out.withColumn("doc_id", doc_id(F.col(key), F.col("source_title"), F.col("chunk_count"))).withColumn("chunk_id", chunk_id(F.col("doc_id"), F.col("chunk_index")))
    out = linked(out, [key], ["chunk_index"])
    return out.select(
        key, F.col("question").alias("input"), "summary", F.coalesce("output", F.lit("")).alias("output"), *(F.coalesce(F.get(questions, F.lit(i)), F.lit("")).alias(f"alt_question_{i + 1}") for i in range(3)),
        "doc_id", "chunk_id", "chunk_index", "chunk_count", "chunk_start", "chunk_end", "source_title", "source_chunk_total", "page_start", "page_end", "prev_chunk_id", "next_chunk_id",
    )


def is_oversized(text: Column, cap: Column | int) -> Column:
    """more tokens than the cap."""
    return F.coalesce(token_count(text) > cap, F.lit(False))


def latest_delivery(records: DataFrame, key: str = "chunk_id", at: str = "loaded_at", tie: str = "row_no") -> DataFrame:
    """One row per key, the latest (a null time is the earliest, the higher row number wins a tie); rows without key stay.

    An aggregate of (time, row number) is joined back, so that no key's rows are sorted in one task.
    """
    last = records.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(tie, F.struct(F.coalesce(F.col(at), F.lit("0001-01-01").cast("timestamp")), F.col(tie))).alias(tie))
    return records.join(last, [key, tie], "left_semi").unionByName(records.where(F.col(key).isNull()))
