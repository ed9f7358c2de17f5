"""Volumes of stage-1 chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions.text import squeeze
from quillstone.runtime import table

#: What tells a volume.
VOLUME = ["source_file", "chunk_total", "volume"]


def volume_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Stage-1 chunks with ``volume``: chunks of a volume stand in a row, so the difference of row number and position tells volumes of one file and length apart."""
    c = table(spark, d, "source_chunks")
    return c.where("source_file is not null").withColumn("volume", F.col("chunk_row") - F.col("chunk_index"))


def document_volumes(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id`` and the volume of stage-1 chunks it was made of: of the same file and length, of the same title if there are several."""
    title = F.max(F.lower(squeeze(F.col("source_title")))).alias("title")
    docs = table(spark, d, "ingest_records").where("doc_id is not null").groupBy("doc_id").agg(F.max("source_file").alias("source_file"), F.max("source_chunk_total").alias("chunk_total"), title)
    vols = volume_chunks(spark, d).groupBy(*VOLUME).agg(title.alias("v_title"))
    best = F.max_by("volume", F.struct(F.coalesce(F.col("title") == F.col("v_title"), F.lit(False)), F.negative("volume")))
    return docs.join(vols, ["source_file", "chunk_total"]).groupBy("doc_id").agg(best.alias("volume"))
