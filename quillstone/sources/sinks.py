"""Sinks: JSON, catalogue maps, CSV, text, part files, metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    """K1, K2, K5: JSON lines; a folder is complete or not there, as the commit protocol renames it."""
    df.write.mode("overwrite").json(path)


def map_lines(catalog: DataFrame, key: str) -> DataFrame:
    """K3: one line ``{"key": {...}}`` per row, so that a large catalogue is never one value."""
    return catalog.select(F.to_json(F.map_from_arrays(F.array(F.col(key)), F.array(F.struct(*(c for c in catalog.columns if c != key))))).alias("value"))


def append_csv(df: DataFrame, path: str) -> None:
    """K4."""
    df.write.mode("append").option("header", True).csv(path)


def versioned(path: str, stamp: str) -> str:
    """K6: where an earlier version is kept."""
    return f"{path.rstrip('/')}.version={stamp}"


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def backup(spark: SparkSession, path: str, stamp: str) -> str | None:
    """K6: what lies at ``path`` moved to its versioned name before it is written anew; None where nothing is there."""
    fs, source = _fs(spark, path)
    if not fs.exists(source):
        return None
    name = versioned(path, stamp)
    if not fs.rename(source, _fs(spark, name)[1]):
        raise OSError(f"cannot keep {path} as {name}")
    return name


def export(df: DataFrame, folder: str, stamp: str) -> str:
    """K5: an export under a name with its time; an earlier one of the same time is kept aside (K6)."""
    path = f"{folder.rstrip('/')}/export_{stamp}"
    backup(df.sparkSession, path, "before")
    write_json(df, path)
    return path


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file written by the driver through the cluster's file system."""
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_lines(df: DataFrame, path: str) -> None:
    """K7: a ``value`` column as text."""
    df.select("value").write.mode("overwrite").text(path)


def part_table(files: DataFrame, limit: int, fill: float = 0.95) -> DataFrame:
    """K8: ``name, part, parts, start, end``: byte ranges of files cut below a size."""
    step = int(limit * fill)
    parts = F.greatest(F.lit(1), F.ceil(F.col("length") / step)).cast("int")
    p = files.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(1), parts)))
    stem = F.regexp_replace("name", r"\.([^.]+)$", "")
    ext = F.regexp_extract("name", r"(\.[^.]+)$", 1)
    name = F.when(F.col("parts") == 1, F.col("name")).otherwise(F.format_string("%s-%05d-of-%05d%s", stem, "part", "parts", ext))
    return p.select("name", name.alias("part_name"), "part", "parts", ((F.col("part") - 1) * step).alias("start"), F.least(F.col("part") * step, "length").alias("end"))


def to_upload(local: DataFrame, remote: DataFrame, key: str = "name", at: str = "modified") -> DataFrame:
    """Local files that are not there remotely, or newer."""
    r = remote.select(key, F.col(at).alias("_r"))
    return local.join(r, key, "left").where(F.col("_r").isNull() | (F.col(at) > F.col("_r"))).drop("_r")


def size_differs(local: DataFrame, expected: DataFrame, key: str = "name", size: str = "length") -> DataFrame:
    """Files whose local size is not the expected one, or that are not there: ``key, local, expected``."""
    j = expected.select(key, F.col(size).alias("expected")).join(local.select(key, F.col(size).alias("local")), key, "left")
    return j.where(~F.col("local").eqNullSafe(F.col("expected"))).select(key, "local", "expected")


def with_metadata(old: DataFrame, new: DataFrame, removed: DataFrame) -> DataFrame:
    """Key-value pairs, the new ones replacing the old, without the removed keys."""
    j = old.withColumnRenamed("value", "_o").join(new.withColumnRenamed("value", "_n"), "key", "full_outer")
    return j.select("key", F.coalesce("_n", "_o").alias("value")).join(removed, "key", "left_anti")


def section_inserted(text: Column, section: Column) -> Column:
    """A section after the second line of three hyphens; in front where there is none."""
    at = F.regexp_instr(text, F.lit(r"(?s)^(?:.*?\n)?---\n.*?\n---\n"))
    head = F.regexp_extract(text, r"(?s)^((?:.*?\n)?---\n.*?\n---\n)", 1)
    return F.when(at == 0, F.concat(section, F.lit("\n"), text)).otherwise(F.concat(head, section, F.lit("\n"), F.substring(text, F.length(head) + 1, F.length(text))))


def replaced_unless(text: Column, old: str, new: str, unless: str) -> Column:
    """Literal replacement, except in texts that hold ``unless``."""
    return F.when(F.contains(text, F.lit(unless)), text).otherwise(F.replace(text, F.lit(old), F.lit(new)))
