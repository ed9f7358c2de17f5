"""Problem 1: exact token totals per source, language and domain."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.runtime import salted_join

from .copies import with_copies
from .tokenizer import PRE_TOKEN, TOKENIZER_DIR, read_ranks


@lru_cache(maxsize=4)
def _encoding(tokens: tuple[bytes, ...]):
    import tiktoken

    return tiktoken.Encoding("vocabulary", pat_str=PRE_TOKEN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def count_tokens(df: DataFrame, text: str, vocabulary: str) -> DataFrame:
    """``df`` with ``n_tokens``: the length of ``text`` under the vocabulary; no shuffle."""
    tokens = df.sparkSession.sparkContext.broadcast(tuple(read_ranks(vocabulary)))
    names = df.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokens.value).encode_ordinary
        for b in batches:
            n = np.fromiter((len(encode(t)) if t else 0 for t in b.column(at).to_pylist()), np.int64, b.num_rows)
            keep = [i for i in range(len(names)) if i != at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(n)], names=[*(names[i] for i in keep), "n_tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return df.mapInArrow(run, f"{schema}, n_tokens bigint")


def _squeezed(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def token_budget(records: DataFrame, manifest: DataFrame, vocabulary: str = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken") -> DataFrame:
    """Token totals of ``records.output`` by slice.

    Whole texts are hashed (SHA-256) and each distinct text is tokenised once, in
    the first of its rows; the counts are joined back to the multiplicity of the
    text in each file and title. Hashes and counts are shuffled, texts are not. Language and domain
    are those of the file's latest manifest row by ``generated_at`` (then
    ``manifest_row``); files without one, and null values there, form a slice
    of their own (null). Titles are compared without case and spacing and shown
    in their most frequent spelling of the file; a null title is a title of its
    own. Null and empty outputs have no tokens but count as records. Each
    delivered row counts; ``n_tokens_distinct`` counts every different text of
    a slice once. Empty tables give one row, the total, of zeros.

    Columns: ``level`` (``file``, ``source``, ``language``, ``domain``,
    ``language_domain``, ``total``), ``source_file``, ``source_title``,
    ``lang``, ``domain``, ``n_records``, ``n_texts``, ``n_tokens``,
    ``n_tokens_distinct``.
    """
    base = records.select(
        "row_no", F.col("source_file"), _squeezed(F.col("source_title")).alias("title"),
        F.nullif(F.col("output").cast("string"), F.lit("")).alias("text"),
    ).withColumn("h", F.unhex(F.sha2("text", 256)))
    # the first row of each text is tokenised where it lies; repeated rows give the same count again
    first = with_copies(base.where("h is not null"), "row_no", "text").where("not again").select("h", "text")
    counted = count_tokens(first, "text", vocabulary).groupBy("h").agg(F.max("n_tokens").alias("n_tokens"))

    spelled = base.groupBy("source_file", F.lower("title").alias("title_key"), "title").count()
    pick = Window.partitionBy("source_file", "title_key").orderBy(F.desc("count"), "title")
    shown = spelled.withColumn("n", F.row_number().over(pick)).where("n = 1").select("source_file", "title_key", F.col("title").alias("source_title"))

    latest = manifest.where("output_json is not null").groupBy("output_json").agg(F.max_by(F.struct("lang", "domain"), F.struct("generated_at", "manifest_row")).alias("m"))
    dims = latest.select(F.col("output_json").alias("source_file"), "m.lang", "m.domain")

    many = base.groupBy("source_file", F.lower("title").alias("title_key"), "h").agg(F.count(F.lit(1)).alias("n"))
    rows = (
        salted_join(many.join(counted, "h", "left"), dims, ["source_file"], "left")
        .select("source_file", "title_key", "lang", "domain", "h", "n", F.coalesce("n_tokens", F.lit(0)).alias("t"))
    )
    sets = {"file": ["source_file", "title_key", "lang", "domain"], "source": ["source_file", "lang", "domain"], "language": ["lang"], "domain": ["domain"], "language_domain": ["lang", "domain"], "total": []}
    # every slice a text belongs to; partial sums per (slice, text) make the distinct count exact without a second pass over texts
    keys = ["source_file", "title_key", "lang", "domain"]
    expanded = rows.select("h", "n", "t", F.explode(F.array(*(F.struct(F.lit(k).alias("level"), *(F.col(c) if c in cols else F.lit(None).cast("string").alias(c) for c in keys)) for k, cols in sets.items()))).alias("s"))
    per_text = expanded.groupBy("s", "h").agg(F.sum("n").alias("n"), F.max("t").alias("t"))
    totals = per_text.groupBy("s").agg(
        F.sum("n").alias("n_records"), F.count("h").alias("n_texts"), F.sum(F.col("n") * F.col("t")).alias("n_tokens"), F.sum("t").alias("n_tokens_distinct")
    ).select("s.*", "n_records", "n_texts", "n_tokens", "n_tokens_distinct")
    totals = totals.unionByName(_zero_total(totals)).groupBy("level", *keys).agg(*(F.sum(c).alias(c) for c in ("n_records", "n_texts", "n_tokens", "n_tokens_distinct")))
    on = [totals["source_file"].eqNullSafe(shown["source_file"]), totals["title_key"].eqNullSafe(shown["title_key"]), totals["level"] == "file"]
    return totals.join(shown, on, "left").select("level", totals["source_file"], "source_title", "lang", "domain", "n_records", "n_texts", "n_tokens", "n_tokens_distinct")


def _zero_total(like: DataFrame) -> DataFrame:
    zero = {f.name: F.lit("total") if f.name == "level" else (F.lit(0) if f.name.startswith("n_") else F.lit(None)).cast(f.dataType) for f in like.schema}
    return like.sparkSession.range(1).select(*(c.alias(n) for n, c in zero.items()))
