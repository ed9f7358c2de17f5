"""Session helpers shared by every operator: shared folder, lineage cuts, input repartitioning."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one where that is unset (tests, local mode)."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="quillstone-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return _own_dir


def _path(spark: SparkSession, path: str):
    """The folder as the JVM's file system and path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


_cuts: list[tuple[SparkSession, str]] = []


def release() -> None:
    """Remove every table that ``cut`` wrote. For long sessions, once the results built on them are stored; else done when the driver ends."""
    while _cuts:
        spark, path = _cuts.pop()
        try:
            fs, target = _path(spark, path)
            fs.delete(target, True)
        except Exception:  # the session is gone: nothing is left to clean through it
            pass


atexit.register(release)


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quillstone/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _cuts.append((spark, path))
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where an expensive stage feeds several branches; the written table
    outlives lost executors, unlike a cache or a local checkpoint. The folder
    is removed by ``release`` or when the driver process ends.
    """
    return _written(df)[0]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need no copy of the repository."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).parent
    folder = Path(tempfile.mkdtemp(prefix="quillstone-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "quillstone_package.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(folder / "quillstone_package.zip"))


#: A side is broadcast only if, once written, it has at most this many rows and compressed bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 4 << 20


def measured(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` written to the shared folder, and whether it is small enough to be broadcast."""
    out, path = _written(df)
    fs, target = _path(df.sparkSession, path)
    return out, fs.getContentSummary(target).getLength() <= BROADCAST_BYTES and out.count() <= BROADCAST_ROWS


def salts(spark: SparkSession) -> int:
    """Over how many tasks a hot key is spread: the cluster's cores, 64 at most."""
    return max(4, min(64, spark.sparkContext.defaultParallelism))


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``large`` joined to ``small``, null keys matching null.

    The small side is written and measured. Below the bound it is broadcast, so
    ``large`` is not shuffled. Beyond it rows of ``large`` get a salt and rows of
    ``small`` are copied for each salt, so that a key with a third of all rows
    is shuffled to many tasks. The result is the same.
    """
    side, fits = measured(small)
    side = side.select(*(F.col(k).alias(f"_key_{k}") for k in keys), *(c for c in small.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    if fits:
        return large.join(F.broadcast(side), on, how).drop(*(f"_key_{k}" for k in keys))
    n = salts(large.sparkSession)
    side = side.withColumn("_salt_s", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    salted = large.withColumn("_salt_l", F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int"))
    return salted.join(side.hint("merge"), [*on, F.col("_salt_l") == F.col("_salt_s")], how).drop(*(f"_key_{k}" for k in keys), "_salt_l", "_salt_s")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
