"""Sources: JSON arrays and maps, manifests, key=value text, overrides, binary matrices, tolerant files."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = "input string, output string, summary string, source_title string, start_page int, end_page int, chunk_index int, chunk_total int, word_count int"
STATUS = "files array<struct<pdf_file string, output_json string, status string, `exists` boolean>>, generated_at string, generator string, cwd string"


def json_array(spark: SparkSession, path: str, schema: str = CHUNK) -> DataFrame:
    """A file that is one JSON array of objects, a row each, with the file's name."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("source_file", F.col("_metadata.file_name"))


def object_map(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` (VARIANT) of a file that is one JSON object keyed by id.

    Schema inference would make a column of every key, so the text is parsed to a map and exploded.
    """
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,variant>")).alias("key", "value"))


def variant_field(value: Column, name: str, kind: str) -> Column:
    """A field of a VARIANT, null where it is missing or of another kind (an empty text for a number)."""
    return F.try_variant_get(value, f"$.{name}", kind)


def model_list(spark: SparkSession, path: str) -> DataFrame:
    """``name, is_moe`` of ``{"models": [...]}`` whose entries are names or objects."""
    whole = spark.read.text(path, wholetext=True)
    m = whole.select(F.explode(F.from_json("value", "models array<variant>")["models"]).alias("v"))
    return m.select(F.coalesce(F.try_variant_get("v", "$.name", "string"), F.try_variant_get("v", "$", "string")).alias("name"), F.coalesce(F.try_variant_get("v", "$.is_moe", "boolean"), F.lit(False)).alias("is_moe"))


def is_source_file(name: Column) -> Column:
    """Names of first-stage files; retries, statuses, outputs, work files and copies with a time stamp are none."""
    return name.endswith(".json") & ~name.rlike(r"^(?:retry_|semantic_batch_status)|_out_|_semantic_(?:work|ingest)(?:_|\.json$)|_\d{14}\.json$")


def files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """``path, name, length, modified`` of the files of a folder, contents not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return f.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def largest(sizes: DataFrame, folder: str, n: int) -> DataFrame:
    """Total bytes of each first-level entry below a folder, the ``n`` largest."""
    top = F.regexp_extract("path", rf"\Q{folder.rstrip('/')}\E/([^/]+)", 1)
    return sizes.groupBy(top.alias("entry")).agg(F.sum("length").alias("bytes")).orderBy(F.desc("bytes"), "entry").limit(n)


def manifest_files(manifest: DataFrame) -> DataFrame:
    """Usable entries of exploded manifests, each file once by its first position; the latest ``generated_at`` of a file decides."""
    last = manifest.where("output_json is not null").groupBy("output_json").agg(F.max_by(F.struct("status", "file_exists", "lang", "domain", "pdf_file", "manifest_row"), F.struct("generated_at", "manifest_row")).alias("m"), F.min("manifest_row").alias("position"))
    return last.where(F.col("m.status").isin("converted", "existing") & F.coalesce("m.file_exists", F.lit(False))).select("output_json", "position", "m.pdf_file", "m.lang", "m.domain")


def nested_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest file exploded to a row per entry with its position."""
    m = spark.read.schema(STATUS).option("multiLine", True).json(path)
    return m.select("generated_at", "generator", "cwd", F.posexplode("files").alias("position", "f")).select("generated_at", "generator", "cwd", "position", "f.*")


def key_values(lines: DataFrame, column: str = "value") -> DataFrame:
    """``name, kind, raw`` of lines ``name=KIND (raw)`` or ``name=KIND``; others are left out."""
    rest = F.split(column, "=", 2)
    return lines.where(F.col(column).contains("=")).select(
        F.btrim(rest[0]).alias("name"), F.regexp_extract(rest[1], r"^\s*([^\s(]+)", 1).alias("kind"), F.nullif(F.regexp_extract(rest[1], r"\(([^)]*)\)", 1), F.lit("")).try_cast("int").alias("raw")
    )


def overrides(lines: DataFrame, column: str = "value") -> DataFrame:
    """``key, type, text, number, flag`` of lines ``key=type:value``; blank lines, comments and malformed lines are left out."""
    t = F.btrim(column)
    kind, value = F.regexp_extract(t, r"^[^=#]+=(int|float|bool|str):", 1), F.regexp_extract(t, r"^[^=]+=\w+:(.*)$", 1)
    out = lines.select(F.btrim(F.regexp_extract(t, r"^([^=#]+)=", 1)).alias("key"), kind.alias("type"), value.alias("text")).where("type <> ''")
    return out.withColumn("number", F.when(F.col("type").isin("int", "float"), F.col("text").try_cast("double"))).withColumn("flag", F.when(F.col("type") == "bool", F.lower("text").isin("true", "1", "yes")))


def parse_matrix(data: bytes) -> list[tuple[str, int, list[float]]]:
    """``(name, calls, values)`` of a length-prefixed little-endian matrix file; a truncated file raises ValueError."""
    try:
        (n,), at = struct.unpack_from("<i", data), 4
        out = []
        for _ in range(n):
            (size,) = struct.unpack_from("<i", data, at)
            name = data[at + 4 : at + 4 + size].decode()
            calls, count = struct.unpack_from("<ii", data, at + 4 + size)
            at += 12 + size
            out.append((name, calls, list(struct.unpack_from(f"<{count}f", data, at))))
            at += 4 * count
        return out
    except struct.error as e:
        raise ValueError("matrix file ends early") from e


def matrices(spark: SparkSession, path: str) -> DataFrame:
    """``path, name, calls, values`` of matrix files, a task per file."""
    src = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = parse_matrix(content.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(rows)), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.float32()))], names=["path", "name", "calls", "values"])

    return src.mapInArrow(run, "path string, name string, calls int, values array<float>")


def measurements(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of names, perplexities and times whose values may be ``ERROR``."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    name, value, took = raw.columns[:3]
    return raw.select(F.col(name).alias("name"), F.col(value).try_cast("double").alias("perplexity"), F.col(took).try_cast("double").alias("seconds"))


def tolerant_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Status files, a row each; ``broken`` tells those that do not parse."""
    df = spark.read.schema(schema + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("file", F.col("_metadata.file_name")).withColumn("broken", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


def alias_option(options: dict, *names: str, default: object = None) -> object:
    """The first of several spellings that is set, false and 0 included."""
    return next((options[n] for n in names if options.get(n) is not None), default)


def find_manifest(*folders: str, name: str = "stage1_json_manifest.json") -> str:
    """The one manifest in the first folder that has any; more than one below it is an error. Driver-side."""
    from pathlib import Path

    for folder in filter(None, folders):
        if (direct := Path(folder) / name).is_file():
            return str(direct)
        below = sorted(Path(folder).glob(f"*/{name}"))
        if len(below) > 1:
            raise ValueError(f"more than one manifest below {folder}")
        if below:
            return str(below[0])
    raise FileNotFoundError(name)


#: Scalar types of the model file format by number (struct codes).
_GGUF_SCALARS = {0: "B", 1: "b", 2: "H", 3: "h", 4: "I", 5: "i", 6: "f", 7: "?", 10: "Q", 11: "q", 12: "d"}


def parse_gguf(data: bytes) -> tuple[dict[str, object], list[tuple[str, list[int], int]]]:
    """Metadata and tensors ``(name, shape, type number)`` of the head of a GGUF file, version 2 or later; a broken head raises ValueError."""
    if data[:4] != b"GGUF":
        raise ValueError("not a GGUF file")
    at = 4

    def take(code: str) -> int | float | bool:
        nonlocal at
        (x,) = struct.unpack_from("<" + code, data, at)
        at += struct.calcsize("<" + code)
        return x

    def text() -> str:
        nonlocal at
        n = take("Q")
        if at + n > len(data):
            raise ValueError("GGUF head ends early")
        at += n
        return data[at - n : at].decode("utf-8", "replace")

    def value(kind: int) -> object:
        if kind == 8:
            return text()
        if kind == 9:
            inner, n = take("I"), take("Q")
            return [value(inner) for _ in range(n)]
        return take(_GGUF_SCALARS[kind])

    try:
        take("I")
        n_tensors, n_pairs = take("Q"), take("Q")
        pairs = {}
        for _ in range(n_pairs):
            key = text()
            pairs[key] = value(take("I"))
        tensors = []
        for _ in range(n_tensors):
            name = text()
            shape = [take("Q") for _ in range(take("I"))]
            kind = take("I")
            take("Q")
            tensors.append((name, shape, kind))
        return pairs, tensors
    except (struct.error, KeyError) as e:
        raise ValueError("GGUF head ends early") from e


def gguf_tensors(spark: SparkSession, path: str) -> DataFrame:
    """``path, name, shape, kind`` of the tensors of GGUF files, a task per file; names without ``.weight``."""
    src = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = parse_gguf(content.as_py())[1]
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(rows), pa.string()), pa.array([r[0].removesuffix(".weight") for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.int32())], names=["path", "name", "shape", "kind"])

    return src.mapInArrow(run, "path string, name string, shape array<bigint>, kind int")


def outline(entries: DataFrame, book: str, last_page: str) -> DataFrame:
    """A nested outline flattened: ``book, title, start_page, end_page, depth``.

    ``entries``: ``book, path`` (positions from the top, array<int>), ``title,
    page``; nulls for pages that do not resolve are left out. Entries are read
    in the order of their paths, the first title of a page counts, and a section
    ends before the next begins, the last one at ``last_page``.
    """
    rank = F.struct("path")
    first = entries.where(F.col("page").isNotNull()).groupBy(book, "page").agg(F.min_by(F.struct("title", F.size("path").alias("depth")), rank).alias("e"), F.max(last_page).alias("_last"))
    after = F.lead("page").over(Window.partitionBy(book).orderBy("page"))
    return first.select(book, F.col("e.title").alias("title"), F.col("page").alias("start_page"), F.greatest("page", F.coalesce(after - 1, "_last")).alias("end_page"), "e.depth")


def page_lines(pages: DataFrame, book: str, page: str, text: str) -> DataFrame:
    """Pages as lines: ``book, page, line_no, line``; null pages have none. Page texts come from any extractor as rows."""
    return pages.where(F.col(text).isNotNull()).select(book, page, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))


def inspected(df: DataFrame, n: int = 5) -> tuple[list[tuple[str, str]], DataFrame]:
    """Names and kinds of the columns, and the first rows."""
    return df.dtypes, df.limit(n)
