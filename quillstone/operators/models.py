"""Operators over model files and their history: A16-A18, F9, F13, H5, M7, N5, P5, X21."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_stem(path: Column, suffix: str = "") -> Column:
    """P5: a path's last part without its extension, with a suffix put on."""
    return F.concat(F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", ""), F.lit(suffix))


def old_files(files: DataFrame, needles: list[str], now: Column, days: int) -> DataFrame:
    """files whose name holds one of the needles, whatever the case, and that are older than so many days."""
    name = F.lower("name")
    holds = F.exists(F.array(*(F.lit(n.lower()) for n in needles)), lambda n: F.contains(name, n)) if needles else F.lit(False)
    return files.where(holds & (F.col("modified") < now - F.expr(f"interval {days} days")))


def relevant_changes(commits: DataFrame, pattern: str, lines: int = 10) -> DataFrame:
    """of each commit (``sha, files array<struct<filename, patch>>``) the files whose name matches, with the first lines of their patch."""
    kept = F.transform(F.filter("files", lambda f: f["filename"].rlike(pattern)), lambda f: F.struct(f["filename"].alias("filename"), F.slice(F.split(f["patch"], "\n"), 1, lines).alias("lines")))
    return commits.select("sha", kept.alias("files")).where(F.size("files") > 0)


def best_measurement(measured: DataFrame, group: list[str], name: str, value: str) -> DataFrame:
    """Per group the name of the least value and the distance between least and greatest; nulls are no measurements."""
    return measured.where(F.col(value).isNotNull()).groupBy(*group).agg(F.min_by(name, F.struct(value, name)).alias("best"), (F.max(value) - F.min(value)).alias("distance"), F.count(F.lit(1)).alias("n"))


def expert_stacks(tensors: DataFrame, n_experts: int) -> DataFrame:
    """Per layer and weight the experts' tensors in order, and whether none is missing. Names: ``layers.L.experts.E.W``."""
    part = lambda i: F.regexp_extract("name", r"layers\.(\d+)\..*?experts\.(\d+)\.(\w+)", i)
    t = tensors.where(part(1) != "").select("name", part(1).cast("int").alias("layer"), part(2).cast("int").alias("expert"), part(3).alias("weight"))
    g = t.groupBy("layer", "weight").agg(F.sort_array(F.collect_list(F.struct("expert", "name"))).alias("s"), F.count_distinct("expert").alias("n"))
    return g.select("layer", "weight", F.transform("s", lambda x: x["name"]).alias("names"), (F.col("n") == n_experts).alias("complete"))


def known_fingerprint(rows: DataFrame, content: str, known: DataFrame) -> DataFrame:
    """H5: rows with the ``name`` that a table of SHA-256 fingerprints has for their content, null where it has none."""
    return rows.withColumn("fingerprint", F.sha2(F.col(content), 256)).join(known, "fingerprint", "left")


def effective_size(parameters: Column, active: Column, is_mixture: Column) -> Column:
    """M7: the active parameters of a mixture where they are known, else all."""
    return F.when(is_mixture & active.isNotNull() & (active > 0), active).otherwise(parameters)


def payload_text(value: Column) -> Column:
    """The text of a VARIANT that is a text, a list of texts or parts, or an object with one."""
    parts = F.try_variant_get(value, "$", "array<variant>")
    of = lambda v: F.coalesce(F.try_variant_get(v, "$.text", "string"), F.try_variant_get(v, "$.content", "string"), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return F.when(parts.isNotNull(), F.array_join(F.transform(parts, of), "")).otherwise(of(value))


def mentions_key(document: Column, pattern: str) -> Column:
    """Whether a JSON document has a key, at any depth, that matches: keys stand before a colon outside of texts."""
    return F.exists(F.regexp_extract_all(document, F.lit(r'"((?:[^"\\]|\\.)*)"\s*:'), 1), lambda k: k.rlike(pattern))


#: By which words a model's description tells of a mixture of experts.
MIXTURE_WORDS = ("mixture of experts", "moe", "multiple experts")


def describes_mixture(readme: Column, words: tuple[str, ...] = MIXTURE_WORDS) -> Column:
    """Whether a description, whatever the case, holds one of the words."""
    return F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(readme), w)), F.lit(False))


def outcome_counts(rows: DataFrame, outcomes: dict[str, Column]) -> DataFrame:
    """One row with how many rows each condition holds for."""
    return rows.agg(*(F.count_if(c).alias(n) for n, c in outcomes.items()))
