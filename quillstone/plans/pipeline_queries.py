"""Queries of the pipeline's reports, the rule engine, model files, sources and sinks, with their SQL."""

from __future__ import annotations

import json
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import scalars
from quillstone.functions import text as t
from quillstone.operators import catalog, intervals, models, rules, segmentation
from quillstone.plans import reports
from quillstone.plans.text_queries import NSP, TOK
from quillstone.plans.volumes import VOLUME, document_volumes, volume_chunks
from quillstone.runtime import shared_dir, table
from quillstone.sources import readers, sinks
from quillstone.streaming import incremental


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one, for a round trip through files."""
    return f"{shared_dir(spark).rstrip('/')}/quillstone/files-{uuid.uuid4().hex}"


def volumes_of_documents(spark: SparkSession, d: str) -> DataFrame:
    """Each document's volume of stage-1 chunks."""
    return document_volumes(spark, d)


def resplit_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of every volume with those over their file's cap cut into parts, renumbered; texts by length and hash."""
    vols = document_volumes(spark, d)
    r = table(spark, d, "ingest_records").where("doc_id is not null").select("row_no", "doc_id", "source_file", "output", "chunk_index", "chunk_start", "chunk_end")
    chunks = volume_chunks(spark, d).join(vols, "volume").select("doc_id", "chunk_index", "output")
    caps = reports.latest_runs(table(spark, d, "stage5_status")).where("token_cap is not null").select("source_file", F.col("token_cap").alias("cap"))
    out = segmentation.resplit_records(r, chunks, caps, "doc_id", 6)
    return out.select("row_no", "doc_id", "part_index", "part_count", "chunk_index", "chunk_count", "chunk_start", "chunk_end", "resplit_applied", F.length("output").alias("n_chars"), F.sha1("output").alias("hash"))


def resplit_report(spark: SparkSession, d: str) -> DataFrame:
    """Per file the rows before and after the resplit and those over the cap before."""
    r = resplit_records(spark, d).join(table(spark, d, "ingest_records").select("row_no", "source_file"), "row_no")
    return r.groupBy("source_file").agg(F.count_distinct("row_no").alias("rows_before"), F.count_distinct(F.when(F.col("resplit_applied"), F.col("row_no"))).alias("oversized_before"))


def stage4_report(spark: SparkSession, d: str) -> DataFrame:
    """Manifest files as work files, runs as their ingest files: fresh or not, and the fields their first record lacks."""
    work = table(spark, d, "manifest_files").where("output_json is not null").groupBy(F.col("output_json").alias("name")).agg(F.max(scalars.iso_time(F.col("generated_at"))).alias("modified"))
    ingest = table(spark, d, "stage5_status").select(F.col("source_file").alias("name"), scalars.iso_time(F.col("updated_at")).alias("modified"))
    there = F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in reports.REQUIRED)))
    keys = table(spark, d, "ingest_records").groupBy(F.col("source_file").alias("name")).agg(F.min_by(there, "row_no").alias("keys"))
    return reports.stage4_report(work, ingest, keys).select("name", "state", F.array_join("missing", ",").alias("missing"))


def step_states(spark: SparkSession, d: str) -> DataFrame:
    """Phases of the stage-5 runs as steps of their files, and the step at work last."""
    s = table(spark, d, "stage5_status").select(F.col("source_file").alias("name"), F.col("phase").alias("step"), F.col("completed_at").alias("finished_at"), "updated_at")
    work = table(spark, d, "ingest_records").where("source_file is not null").select(F.col("source_file").alias("name"))
    return reports.step_flags(s, work, ["split", "regen", "done"])


def input_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Q12, A4: volumes as input files, covered by their records that are no parts of others."""
    r = table(spark, d, "ingest_records").where("doc_id is not null").withColumnRenamed("doc_id", "name")
    whole = r.where("not coalesce(resplit_applied, false)")
    files = r.groupBy("name").agg(F.max("source_chunk_total").alias("total_chunks"), F.bool_or(~F.coalesce("resplit_applied", F.lit(False))).alias("has_output"))
    return reports.input_manifest(files, intervals.coverage(whole, files, "name", "chunk_start", "chunk_end", "total_chunks"))


def weekly_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Q9, A2, F8: documents by week, and how many of them are older than 90 days at a fixed moment."""
    return reports.weekly_catalogue(table(spark, d, "documents"), "added_at", F.lit("2026-01-01").cast("timestamp"), 90)


def _tensors(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    name = F.concat(F.lit("blk."), "p_size", F.lit("."), F.replace("p_name", F.lit(" "), F.lit("_")))
    current = F.when(F.col("p_partkey") % 11 == 0, "F32").when(F.col("p_partkey") % 13 == 0, "MXFP4").otherwise("F16")
    return p.select(F.col("p_brand").alias("model"), F.col("p_partkey").alias("position"), name.alias("name"), current.alias("current"), t.layer_of(name).alias("layer"))


def _rules(spark: SparkSession) -> DataFrame:
    rows = [
        {"rule_no": 1, "base_type": ["IQ2_S", "Q4_K"], "layer_name": ["*_gear"], "bump": 2},
        {"rule_no": 2, "base_type": ["IQ2_S"], "layer_name": ["*red*", "*_bolt"], "bump": 1, "bump_order_low": 2.0, "bump_order_high": 8.0, "bump_order_val": 3},
        {"rule_no": 3, "base_type": ["Q4_K"], "layer_name": ["*_ring"], "bump": 4},
        {"rule_no": 4, "override_types": ["*"], "layer_name": ["*_nut"], "force_type": "f32"},
        {"rule_no": 5, "override_types": ["Q6_K"], "layer_name": ["*_ring"], "order_low": 0.0, "order_high": 5.0},
    ]
    names = [c.split()[0] for c in rules.RULE.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], rules.RULE)


def tensor_types(spark: SparkSession, d: str) -> DataFrame:
    """Parts as tensors, whose types rules raise, override or keep."""
    return rules.tensor_types(_tensors(spark, d), _rules(spark), "IQ2_M", override="q6_k")


def type_arguments(spark: SparkSession, d: str) -> DataFrame:
    """The same as arguments per model, by length and hash."""
    a = rules.type_arguments(rules.tensor_types(_tensors(spark, d), _rules(spark), "IQ2_M", override="q6_k"))
    return a.select("model", "n", F.sha1("arguments").alias("hash"))


def fallback_types(spark: SparkSession, d: str) -> DataFrame:
    """Types that fit a row's size, and those of vectors and norms."""
    p = table(spark, d, "part")
    kind = F.when(F.col("p_size") % 3 == 0, "Q5_K").when(F.col("p_size") % 3 == 1, "Q6_K").otherwise("Q4_K")
    name = F.concat("p_name", F.when(F.col("p_size") % 5 == 0, F.lit("_norm")).otherwise(F.lit("")))
    return p.select("p_partkey", rules.fallback_type(kind, F.col("p_size") * 128).alias("fitted"), rules.tensor_dtype(name, F.col("p_size") % 4, F.lit("Q4_K")).alias("dtype"))


def rate_waits(spark: SparkSession, d: str) -> DataFrame:
    """ST5, W8: when the events of each user might be sent as requests at two a minute, views being refused."""
    e = table(spark, d, "events")
    begin = e.agg(F.min("ts").alias("t0"))
    e = e.crossJoin(F.broadcast(begin)).select("user_id", (F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.col("t0").cast("timestamp"))).cast("double").alias("at"), (F.col("event_type") == "view").alias("refused"))
    w = incremental.rate_waits(e, "user_id", 2, recovery=2)
    return w.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("sent").alias("sent"), F.sum("wait").alias("wait"), F.max("multiplier").alias("multiplier"), F.max("streak").alias("streak"))


def catalogue_scan(spark: SparkSession, d: str) -> DataFrame:
    """Customers stored as key and JSON text, scanned as a whole."""
    c = table(spark, d, "customer")
    lines = c.select(F.col("c_custkey").cast("string").alias("key"), F.to_json(F.struct("c_name", "c_mktsegment", "c_nationkey")).alias("value"))
    s = catalog.full_scan(lines, "key", "value", "c_name string, c_mktsegment string, c_nationkey int")
    return s.groupBy("c_mktsegment").agg(F.count("key").alias("n"), F.sum("c_nationkey").alias("nations"))


def catalogue_row(spark: SparkSession, d: str) -> DataFrame:
    """The row of one key."""
    return catalog.lookup(table(spark, d, "customer"), "c_custkey", 42).select("c_custkey", "c_name")


def catalogue_marks(spark: SparkSession, d: str) -> DataFrame:
    """Orders marked when old or finished, then those not marked, and those without a usable number."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("converted"), F.when(F.col("o_orderkey") % 3 == 0, "n/a").when(F.col("o_orderkey") % 3 == 1, "-1").otherwise("7.5").alias("parameters"), (F.col("o_orderkey") % 5 > 0).alias("has_config"))
    m = catalog.marked(o, "converted", scalars.older_than(F.col("o_orderdate"), F.lit("1998-01-01").cast("timestamp"), 30))
    return catalog.not_converted(m).agg(F.count(F.lit(1)).alias("open")).crossJoin(catalog.unusable(m, "parameters", "has_config").agg(F.count(F.lit(1)).alias("unusable")))


def sorted_by_last_time(spark: SparkSession, d: str) -> DataFrame:
    """Runs by when they failed, else were updated, else the least time: the position of each."""
    s = catalog.by_last_time(table(spark, d, "stage5_status"), "failed_at", "updated_at")
    return s.select("status_id", F.row_number().over(Window.orderBy("sort_time", "status_id")).alias("position"))


def largest_part(spark: SparkSession, d: str) -> DataFrame:
    """The largest part up to a size, with how many there are at most that large."""
    p = table(spark, d, "part")
    return catalog.largest_within(p, "p_size", 30.5, "p_partkey").select("p_partkey", "p_size")


def number_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Whole numbers from a part's size to 45, their count and sum; an emptied catalogue adds none."""
    r = table(spark, d, "part").select("p_partkey", F.explode_outer(scalars.whole_range(F.col("p_size"), F.lit(45))).alias("i"))
    r = r.unionByName(catalog.truncated(r))
    return r.groupBy("p_partkey").agg(F.count("i").alias("n"), F.sum("i").alias("total"))


def name_tests(spark: SparkSession, d: str) -> DataFrame:
    """Names by beginning, end and kind of file."""
    m = table(spark, d, "manifest_files").where("output_json is not null")
    n = F.col("output_json")
    retried = F.when(F.col("manifest_row") % 4 == 0, F.concat(F.lit("retry_"), n)).when(F.col("manifest_row") % 4 == 1, F.regexp_replace(n, r"\.json$", "_semantic_work.json")).otherwise(n)
    return m.select("manifest_row", n.startswith("S").alias("begins"), n.endswith("1.json").alias("ends"), readers.is_source_file(retried).alias("is_source"), models.file_stem(F.concat(F.lit("/books/"), n), "-bf16").alias("stem"))


def classified_errors(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of errors of the runs, and of messages made of event types."""
    s = table(spark, d, "stage5_status").select(F.coalesce("last_error", F.lit("")).alias("m"))
    e = table(spark, d, "events").select(F.when(F.col("event_type") == "view", "HTTP 429 returned").when(F.col("event_type") == "click", "Request timed out.").otherwise(F.col("event_type")).alias("m"))
    return models.outcome_counts(s.union(e), {"timeouts": t.is_timeout(F.col("m")), "limited": t.is_rate_limited(F.col("m")), "n": F.lit(True)})


def old_part_files(spark: SparkSession, d: str) -> DataFrame:
    """line items as files: those of some names shipped long ago."""
    f = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat("l_shipdate", F.lit("_"), "l_returnflag", F.lit("_iq1_"), "l_linestatus").alias("name"), F.col("l_shipdate").alias("modified"))
    return models.old_files(f, ["R_IQ1_F", "a_iq1_f"], F.lit("1999-01-01").cast("timestamp"), 400).groupBy(F.substring("name", -7, 7).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def relevant_changes(spark: SparkSession, d: str) -> DataFrame:
    """orders as commits whose line items are files: those of some suppliers, with the first lines of their patch."""
    li = table(spark, d, "lineitem").select("l_orderkey", F.struct(F.concat(F.lit("convert_"), "l_suppkey", F.lit(".py")).alias("filename"), F.concat_ws("\n", "l_partkey", "l_quantity", "l_linenumber").alias("patch")).alias("f"))
    c = li.groupBy(F.col("l_orderkey").alias("sha")).agg(F.sort_array(F.collect_list("f")).alias("files"))
    r = models.relevant_changes(c, r"^convert_\d*3\.py$", 2)
    return r.select("sha", F.size("files").alias("n"), F.expr("aggregate(files, 0, (a, f) -> a + size(f.lines))").alias("n_lines"))


def best_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Per brand the part of the least price, and the distance to the greatest."""
    m = models.best_measurement(table(spark, d, "part"), ["p_brand"], "p_partkey", "p_retailprice")
    return m.select("p_brand", "best", F.round("distance", 4).alias("distance"), "n")


def expert_stacks(spark: SparkSession, d: str) -> DataFrame:
    """Line items as experts' tensors of their order: in order, and whether all are there."""
    li = table(spark, d, "lineitem").select(F.format_string("layers.%d.mlp.experts.%d.w1", "l_orderkey", F.col("l_linenumber") - 1).alias("name"))
    s = models.expert_stacks(li, 4)
    return s.select("layer", "weight", F.size("names").alias("n"), "complete", F.element_at("names", -1).alias("last"))


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """H5, H3: documents recognised by the SHA-256 of their text, and signatures of their sources."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "source", "text")
    known = docs.where("doc_id <= 50").groupBy(F.sha2("text", 256).alias("fingerprint")).agg(F.min("doc_id").alias("name"))
    return models.known_fingerprint(docs, "text", known).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def effective_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Active parameters of mixtures, which are told by their description or by a field of their configuration."""
    p = table(spark, d, "part")
    readme = F.when(F.col("p_size") % 4 == 0, "A Mixture of Experts model").when(F.col("p_size") % 4 == 1, F.lit(None)).otherwise(F.col("p_name"))
    config = F.when(F.col("p_size") % 3 == 0, '{"a": [{"MoE_layers": 1}]}').otherwise('{"a": "moe"}')
    mixture = models.describes_mixture(readme) | models.mentions_key(config, "(?i)moe")
    return p.select("p_partkey", mixture.alias("is_mixture"), models.effective_size(F.col("p_size").cast("double"), F.when(F.col("p_size") % 2 == 0, 3.0), mixture).alias("size"))


def payload_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of payloads that are a text, a list of parts, or an object."""
    p = table(spark, d, "part")
    j = F.when(F.col("p_size") % 3 == 0, F.to_json(F.struct(F.col("p_name").alias("text")))).when(F.col("p_size") % 3 == 1, F.concat(F.lit('["'), "p_name", F.lit('", {"text": "!"}]'))).otherwise(F.concat(F.lit('"'), "p_name", F.lit('"')))
    return p.select("p_partkey", models.payload_text(F.parse_json(j)).alias("text"))


def uploads(spark: SparkSession, d: str) -> DataFrame:
    """Orders as local files, some older or other copies as remote ones: what to upload, and whose size differs."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("name"), F.col("o_orderdate").alias("modified"), F.floor("o_totalprice").alias("length"))
    remote = o.where("name % 3 <> 0").select("name", F.when(F.col("name") % 3 == 1, F.col("modified")).otherwise(F.col("modified") - F.expr("interval 1 day")).alias("modified"), (F.col("length") + F.when(F.col("name") % 5 == 0, 1).otherwise(0)).alias("length"))
    up = sinks.to_upload(o, remote).agg(F.count(F.lit(1)).alias("n_upload"), F.sum("name").alias("names"))
    return up.crossJoin(sinks.size_differs(o, remote).agg(F.count(F.lit(1)).alias("n_differ")))  # single rows


def edited_notes(spark: SparkSession, d: str) -> DataFrame:
    """A section put into documents, and a word replaced except where another stands."""
    c = table(spark, d, "documents").where("text is not null")
    head = F.concat(F.lit("---\ntitle: x\n---\n"), "text")
    s = sinks.section_inserted(F.when(F.col("doc_id") % 2 == 0, head).otherwise(F.replace("text", F.lit("---"), F.lit("==="))), F.lit("## New"))
    return c.select("doc_id", F.length(s).alias("n_chars"), F.sha1(sinks.replaced_unless(F.col("text"), "the", "THE", "operator")).alias("hash"))


def guarded_blocks(spark: SparkSession, d: str) -> DataFrame:
    """How far the first block of each volume reaches, chunks with few words being headings."""
    c = volume_chunks(spark, d).withColumn("w", t.word_count(F.coalesce("output", F.lit(""))))
    lists = c.where("chunk_index <= 9").groupBy(*VOLUME).agg(F.transform(F.sort_array(F.collect_list(F.struct("chunk_index", "w"))), lambda x: x["w"]).alias("w"))
    many = F.udf(lambda w: segmentation.guarded_end(w, len(w), lambda n: n < 110, lambda n: False, 2, 3), "int", useArrow=True)
    return lists.select(*VOLUME, many("w").alias("reach"))


def report_examples(spark: SparkSession, d: str) -> DataFrame:
    """The first ten failed runs, as examples in a report."""
    s = table(spark, d, "stage5_status").where("coalesce(failed, false)").select("status_id", "source_file", "phase")
    return catalog.examples(s, 10, "status_id")


def written_records(spark: SparkSession, d: str) -> DataFrame:
    """Records exported twice under one name, the later export read back and counted, the earlier one kept."""
    r = table(spark, d, "ingest_records").select("row_no", "source_file", "output", "page_start")
    folder = _folder(spark)
    sinks.export(r.where("row_no % 2 = 0"), folder, "20260101")
    path = sinks.export(r, folder, "20260101")
    schema = "row_no bigint, source_file string, output string, page_start int"
    new, old = (spark.read.schema(schema).json(x) for x in (path, sinks.versioned(path, "before")))
    count = lambda df, n: df.groupBy("source_file").agg(F.count(F.lit(1)).alias(n), F.sum(F.length("output")).alias(f"{n}_chars"))
    return count(new, "n").join(count(old, "n_before").withColumnRenamed("source_file", "f"), F.col("source_file").eqNullSafe(F.col("f")), "left").drop("f")


def written_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue written as lines of one entry each, read back entry by entry with fields of unknown kind."""
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_name", "c_acctbal", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")).alias("nation"))
    path = f"{_folder(spark)}/catalogue"
    sinks.write_lines(sinks.map_lines(c, "id"), path)
    lines = spark.read.text(path).select(F.explode(F.from_json("value", "map<string,variant>")).alias("id", "v"))
    return lines.select("id", readers.variant_field(F.col("v"), "c_name", "string").alias("name"), readers.variant_field(F.col("v"), "nation", "int").alias("nation"), readers.variant_field(F.col("v"), "c_name", "double").alias("wrong"))


def written_csv(spark: SparkSession, d: str) -> DataFrame:
    """Measurements appended twice to CSV, some of them errors, read back."""
    p = table(spark, d, "part").select(F.col("p_name").alias("Quantization"), F.when(F.col("p_size") % 7 == 0, "ERROR").otherwise(F.col("p_size").cast("string")).alias("Perplexity"), F.lit("1.5").alias("Time"))
    path = f"{_folder(spark)}/results"
    sinks.append_csv(p, path)
    sinks.append_csv(p.where("Perplexity <> 'ERROR'"), path)
    return readers.measurements(spark, path).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count("perplexity").alias("n_known"), F.sum("perplexity").alias("total"), F.sum("seconds").alias("seconds"))


def read_nations(spark: SparkSession, d: str) -> DataFrame:
    """One table of 25 rows as a JSON array, an object by key, a list of names and objects, and lines of overrides, each read back."""
    rows = table(spark, d, "nation").orderBy("n_nationkey").limit(25).collect()  # a table of 25 rows
    folder = _folder(spark)
    put = lambda name, text: sinks.write_bytes(spark, f"{folder}/{name}", text.encode())
    put("array.json", json.dumps([{"input": r.n_name, "chunk_index": r.n_nationkey} for r in rows]))
    put("map.json", json.dumps({r.n_name: {"region": r.n_regionkey} for r in rows}))
    put("models.json", json.dumps({"models": [r.n_name if r.n_nationkey % 2 else {"name": r.n_name, "is_moe": True} for r in rows]}))
    put("overrides.txt", "\n".join(["# comment", "broken", *(f"{r.n_name}=int:{r.n_regionkey}" for r in rows)]))
    array = readers.json_array(spark, f"{folder}/array.json").select(F.col("input").alias("name"), F.col("chunk_index").alias("key"), "source_file")
    by_key = readers.object_map(spark, f"{folder}/map.json").select(F.col("key").alias("name"), readers.variant_field(F.col("value"), "region", "int").alias("region"))
    listed = readers.model_list(spark, f"{folder}/models.json")
    over = readers.overrides(spark.read.text(f"{folder}/overrides.txt")).select(F.col("key").alias("name"), F.col("number").alias("given"))
    least = readers.alias_option({"limit": None, "most": 0}, "limit", "most", default=9)
    return array.join(by_key, "name").join(listed, "name").join(over, "name").withColumn("least", F.lit(least))


def read_binaries(spark: SparkSession, d: str) -> DataFrame:
    """A matrix file and the head of a model file made of a table of 25 rows, read back."""
    rows = table(spark, d, "nation").orderBy("n_nationkey").limit(25).collect()  # a table of 25 rows
    folder = _folder(spark)
    entries = b"".join(struct.pack("<i", len(r.n_name)) + r.n_name.encode() + struct.pack("<ii", r.n_nationkey, 2) + struct.pack("<2f", r.n_regionkey, 1.5) for r in rows)
    sinks.write_bytes(spark, f"{folder}/m.dat", struct.pack("<i", len(rows)) + entries)
    text = lambda s: struct.pack("<Q", len(s)) + s.encode()
    tensors = b"".join(text(f"{r.n_name}.weight") + struct.pack("<IQQIQ", 2, r.n_nationkey, 7, r.n_regionkey, 0) for r in rows)
    sinks.write_bytes(spark, f"{folder}/m.gguf", b"GGUF" + struct.pack("<IQQ", 3, len(rows), 1) + text("general.name") + struct.pack("<I", 8) + text("x") + tensors)
    m = readers.matrices(spark, f"{folder}/m.dat").select("name", "calls", F.expr("aggregate(values, 0D, (a, x) -> a + x)").alias("total"))
    g = readers.gguf_tensors(spark, f"{folder}/m.gguf").select("name", F.array_join("shape", "x").alias("shape"), "kind")
    return m.join(g, "name")


def listed_files(spark: SparkSession, d: str) -> DataFrame:
    """A written folder: its files, the largest entries below it, and status files, one of them broken."""
    folder = _folder(spark)
    for n in (1, 2, 3):
        sinks.write_bytes(spark, f"{folder}/b{n}/status_{n}.json", b'{"phase": "done", "rows": %d}' % n if n < 3 else b"{broken")
        sinks.write_bytes(spark, f"{folder}/b{n}/data.bin", b"x" * (100 * n))
    found = readers.files(spark, folder, "*.json").agg(F.count(F.lit(1)).alias("n_files"))
    base = F.regexp_extract(F.lit(folder), r"^(?:file:)?(/.*)$", 1)
    sizes = readers.files(spark, folder, "*.bin").withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    top = readers.largest(sizes, folder.removeprefix("file:"), 2).agg(F.array_join(F.sort_array(F.collect_list("entry")), ",").alias("largest"), F.sum("bytes").alias("bytes"))
    status = readers.tolerant_json(spark, f"{folder}/*/status_*.json", "phase string, rows int").agg(F.count_if("broken").alias("n_broken"), F.sum("rows").alias("n_rows"))
    return found.crossJoin(top).crossJoin(status).drop("base").withColumn("has_base", base != "")  # single rows


def streamed_events(spark: SparkSession, d: str) -> DataFrame:
    """ST1, ST2, ST3, ST6: events arriving as files in two runs, each file processed once; a run begun again adds nothing."""
    folder = _folder(spark)
    e = table(spark, d, "events").select("event_id", "event_type")

    def run() -> None:
        stream = incremental.file_stream(spark, f"{folder}/in", "event_id bigint, event_type string")
        incremental.run_available(stream, lambda df, n: df.write.mode("append").parquet(f"{folder}/out"), f"{folder}/checkpoint")

    for part in (0, 1, None):
        if part is not None:
            e.where(F.pmod("event_id", F.lit(2)) == part).write.mode("append").parquet(f"{folder}/in")
        run()
    return spark.read.schema("event_id bigint, event_type string").parquet(f"{folder}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def completed_passes(spark: SparkSession, d: str) -> DataFrame:
    """ST4, A8: passes over the volumes' missing chunks, a third of what is left in each, until nothing remains or nothing is gained."""
    left = [table(spark, d, "source_chunks").where("output is not null").count()]
    passes, state = incremental.until_complete(lambda n: left.append(left[-1] * 2 // 3), lambda: left[-1], 60)
    return spark.createDataFrame([(left[0], passes, state)], "n bigint, passes int, state string")


_CAPS = "(SELECT source_file, token_cap AS cap FROM stage5_status WHERE updated_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY updated_at DESC, status_id DESC) = 1)"
_TENSORS = """s AS (SELECT p_brand AS model, p_partkey AS position, 'blk.' || p_size || '.' || replace(p_name, ' ', '_') AS name, CASE WHEN p_partkey % 11 = 0 THEN 'F32' WHEN p_partkey % 13 = 0 THEN 'MXFP4' ELSE 'F16' END AS current, p_size::INT AS layer, max(p_size) OVER (PARTITION BY p_brand) AS last FROM part),
    m AS (SELECT *, least(10.0, 10.0 * layer / last) AS place FROM s),
    b AS (SELECT *, CASE WHEN current = 'F32' THEN 0 ELSE CASE WHEN name LIKE '%\\_gear' ESCAPE '\\' THEN 2 ELSE 0 END + CASE WHEN name LIKE '%red%' OR name LIKE '%\\_bolt' ESCAPE '\\' THEN 1 + CASE WHEN place <= 2 OR place >= 8 THEN 3 ELSE 0 END ELSE 0 END END AS bump,
        CASE WHEN name LIKE '%\\_nut' ESCAPE '\\' THEN 'F32' WHEN name LIKE '%\\_ring' ESCAPE '\\' AND place BETWEEN 0 AND 5 THEN 'Q6_K' END AS given FROM m),
    r AS (SELECT model, position, name, current, layer, CASE WHEN current = 'MXFP4' THEN 'mxfp4' ELSE coalesce(given, ['IQ1_S', 'IQ1_M', 'IQ2_XXS', 'IQ2_XS', 'IQ2_S', 'IQ3_XXS', 'IQ3_S', 'IQ4_NL', 'IQ4_XS', 'Q4_K', 'Q5_K', 'Q6_K', 'Q8_0'][5 + bump]) END AS type,
        CASE WHEN current = 'MXFP4' THEN 'kept' WHEN given IS NOT NULL THEN 'rule' WHEN bump <> 0 THEN 'bump' END AS why FROM b)"""

SQL = {
    "volumes_of_documents": r"""WITH d AS (SELECT doc_id, max(source_file) AS f, max(source_chunk_total) AS n, max(lower(trim(regexp_replace(source_title, '[\s\p{Z}]+', ' ', 'g')))) AS title FROM ingest_records WHERE doc_id IS NOT NULL GROUP BY 1),
        v AS (SELECT source_file, chunk_total, chunk_row - chunk_index AS volume, max(lower(trim(regexp_replace(source_title, '[\s\p{Z}]+', ' ', 'g')))) AS title FROM source_chunks WHERE source_file IS NOT NULL GROUP BY ALL)
        SELECT doc_id, volume FROM d JOIN v ON v.source_file = d.f AND v.chunk_total = d.n QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(d.title = v.title, FALSE) DESC, volume) = 1""",
    "resplit_report": f"SELECT source_file, count(*) AS rows_before, count(*) FILTER (len(regexp_extract_all(output, '{TOK}')) > cap) AS oversized_before FROM ingest_records r LEFT JOIN {_CAPS} c USING (source_file) WHERE doc_id IS NOT NULL GROUP BY 1",
    "stage4_report": f"""WITH w AS (SELECT output_json AS name, max(try_cast(generated_at AS TIMESTAMPTZ)) AS m FROM manifest_files WHERE output_json IS NOT NULL GROUP BY 1), i AS (SELECT source_file AS name, max(try_cast(updated_at AS TIMESTAMPTZ)) AS i FROM stage5_status GROUP BY 1),
        k AS (SELECT source_file AS name, list_sort([c FOR c IN [{", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in reports.REQUIRED)}] IF c IS NOT NULL]) AS x FROM ingest_records QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY row_no) = 1),
        j AS (SELECT name, coalesce(i >= m, FALSE) AS fresh, coalesce(x, list_sort([{", ".join(f"'{c}'" for c in reports.REQUIRED)}])) AS x FROM w LEFT JOIN i USING (name) LEFT JOIN k USING (name))
        SELECT name, CASE WHEN NOT fresh THEN 'stale_or_missing' WHEN len(x) > 0 THEN 'schema_fail' ELSE 'schema_ok' END AS state, CASE WHEN fresh THEN array_to_string(x, ',') ELSE '' END AS missing FROM j""",
    "step_states": """WITH p AS (SELECT source_file AS name, coalesce(bool_or(phase = 'split' AND completed_at IS NOT NULL), FALSE) AS split, coalesce(bool_or(phase = 'regen' AND completed_at IS NOT NULL), FALSE) AS regen, coalesce(bool_or(phase = 'done' AND completed_at IS NOT NULL), FALSE) AS done,
        (array_agg(phase ORDER BY updated_at DESC NULLS LAST, phase DESC) FILTER (completed_at IS NULL))[1] AS active FROM stage5_status GROUP BY 1),
        j AS (SELECT name, coalesce(split, FALSE) AS split, coalesce(regen, FALSE) AS regen, coalesce(done, FALSE) AS done, active FROM (SELECT DISTINCT source_file AS name FROM ingest_records WHERE source_file IS NOT NULL) LEFT JOIN p USING (name))
        SELECT *, CASE WHEN split AND regen AND done THEN 'complete' WHEN split OR regen OR done THEN 'partial' ELSE 'pending' END AS state FROM j""",
    "input_manifest": """WITH t AS (SELECT doc_id AS name, max(source_chunk_total) AS n, bool_or(NOT coalesce(resplit_applied, FALSE)) AS has FROM ingest_records WHERE doc_id IS NOT NULL GROUP BY 1),
        c AS (SELECT doc_id AS name, count(DISTINCT i) AS k FROM (SELECT doc_id, source_chunk_total, unnest(generate_series(chunk_start, chunk_end)) AS i FROM ingest_records WHERE doc_id IS NOT NULL AND NOT coalesce(resplit_applied, FALSE)) WHERE i >= 1 AND i <= source_chunk_total GROUP BY 1)
        SELECT name, coalesce(n, 0)::INT AS total_chunks, CASE WHEN coalesce(n, 0) = 0 THEN 'complete' WHEN NOT has THEN 'no_output' WHEN n = coalesce(k, 0) THEN 'complete' ELSE 'incomplete' END AS status, CASE WHEN coalesce(n, 0) = 0 OR NOT has THEN 0 ELSE n - coalesce(k, 0) END::BIGINT AS missing_count FROM t LEFT JOIN c USING (name)""",
    "weekly_catalogue": "SELECT strftime(added_at, '%Y-%W') AS week, count(*) AS n, count(*) FILTER (added_at < TIMESTAMPTZ '2026-01-01 00:00:00+00' - INTERVAL 90 DAY) AS n_old FROM documents WHERE added_at IS NOT NULL GROUP BY 1",
    "tensor_types": f"WITH {_TENSORS} SELECT * FROM r WHERE why IS NOT NULL",
    "type_arguments": f"WITH {_TENSORS} SELECT model, count(*) AS n, sha1(string_agg('--tensor-type ' || name || '=' || type, ' ' ORDER BY layer, position)) AS hash FROM r WHERE why IS NOT NULL GROUP BY 1",
    "fallback_types": "SELECT p_partkey, CASE WHEN p_size % 3 < 2 AND p_size * 128 % 256 <> 0 THEN 'Q5_1' ELSE ['Q5_K', 'Q6_K', 'Q4_K'][p_size % 3 + 1] END AS fitted, CASE WHEN p_size % 4 <= 1 OR p_size % 5 = 0 THEN 'F32' ELSE 'Q4_K' END AS dtype FROM part",
    # a row at a time: the last sent times of a user as a list, then room, spacing and cooldown
    "rate_waits": """WITH RECURSIVE e AS (SELECT user_id, (epoch(date_trunc('second', ts)) - (SELECT epoch(date_trunc('second', min(ts))) FROM events))::DOUBLE AS tm, event_type = 'view' AS refused, row_number() OVER (PARTITION BY user_id ORDER BY epoch(date_trunc('second', ts)), event_type = 'view') AS r FROM events),
        f AS (SELECT user_id, 0::BIGINT AS r, 0::DOUBLE AS tm, 0::DOUBLE AS sent, []::DOUBLE[] AS win, 0::DOUBLE AS free, 0::INT AS streak, 0::INT AS good, 1::DOUBLE AS times FROM (SELECT DISTINCT user_id FROM e) UNION ALL
        SELECT user_id, r, tm, sent, list_append(win, sent), CASE WHEN refused THEN greatest(free, sent + least(120, 15 * pow(2, streak))) ELSE free END, CASE WHEN refused THEN streak + 1 ELSE 0 END, CASE WHEN refused OR (good + 1 >= 2 AND times > 1) THEN 0 ELSE good + 1 END,
               CASE WHEN refused THEN least(4.0, times + 0.25) WHEN good + 1 >= 2 AND times > 1 THEN greatest(1.0, times - 0.25) ELSE times END::DOUBLE FROM (
          SELECT user_id, r, tm, refused, win, free, streak, good, times, CASE WHEN last IS NOT NULL THEN greatest(room, last + 30 * times) ELSE room END AS sent FROM (
            SELECT *, CASE WHEN len(win) >= 2 THEN greatest(base, win[1] + 60) ELSE base END AS room FROM (
              SELECT e.user_id, e.r, e.tm, e.refused, f.free, f.streak, f.good, f.times, CASE WHEN f.r > 0 THEN f.sent END AS last, greatest(e.tm, f.sent, f.free) AS base, list_filter(f.win, lambda x: greatest(e.tm, f.sent, f.free) - x < 60) AS win FROM f JOIN e ON e.user_id = f.user_id AND e.r = f.r + 1))))
        SELECT user_id, count(*) AS n, sum(sent) AS sent, sum(sent - tm) AS wait, max(times) AS multiplier, max(streak) AS streak FROM f WHERE r > 0 GROUP BY 1""",
    "catalogue_scan": "SELECT c_mktsegment, count(*) AS n, sum(c_nationkey)::BIGINT AS nations FROM customer GROUP BY 1",
    "catalogue_row": "SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42",
    "catalogue_marks": """SELECT count(*) FILTER (NOT (coalesce(o_orderstatus = 'F', FALSE) OR o_orderdate < TIMESTAMP '1998-01-01' - INTERVAL 30 DAY)) AS open, count(*) FILTER (o_orderkey % 3 <> 2 OR o_orderkey % 5 = 0) AS unusable FROM orders""",
    "sorted_by_last_time": "SELECT status_id, row_number() OVER (ORDER BY coalesce(try_cast(failed_at AS TIMESTAMPTZ), try_cast(updated_at AS TIMESTAMPTZ), TIMESTAMPTZ '0001-01-01 00:00:00+00'), status_id)::INT AS position FROM stage5_status",
    "largest_part": "SELECT p_partkey, p_size FROM part WHERE p_size <= 30 ORDER BY p_size DESC, p_partkey LIMIT 1",
    "number_ranges": "SELECT p_partkey, greatest(0, 46 - p_size)::BIGINT AS n, CASE WHEN p_size <= 45 THEN (46 - p_size) * (45 + p_size) // 2 END::BIGINT AS total FROM part",
    "name_tests": "SELECT manifest_row, starts_with(output_json, 'S') AS begins, ends_with(output_json, '1.json') AS ends, manifest_row % 4 >= 2 AS is_source, regexp_replace(output_json, '\\.json$', '') || '-bf16' AS stem FROM manifest_files WHERE output_json IS NOT NULL",
    "classified_errors": r"""WITH m AS (SELECT coalesce(last_error, '') AS m FROM stage5_status UNION ALL SELECT CASE event_type WHEN 'view' THEN 'HTTP 429 returned' WHEN 'click' THEN 'Request timed out.' ELSE event_type END FROM events)
        SELECT count(*) FILTER (regexp_matches(m, '(?i)time(d)?[ -]?out')) AS timeouts, count(*) FILTER (regexp_matches(m, '(?i)\b429\b|rate[ _-]?limit|too many requests')) AS limited, count(*) AS n FROM m""",
    "old_part_files": "SELECT l_returnflag || '_iq1_' || l_linestatus AS kind, count(*) AS n FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_linestatus = 'F' AND l_shipdate < TIMESTAMP '1999-01-01' - INTERVAL 400 DAY GROUP BY 1",
    "relevant_changes": "SELECT l_orderkey AS sha, count(*)::INT AS n, (2 * count(*))::INT AS n_lines FROM lineitem WHERE l_suppkey % 10 = 3 GROUP BY 1",
    "best_measurements": "SELECT p_brand, arg_min(p_partkey, (p_retailprice, p_partkey)) AS best, round(max(p_retailprice) - min(p_retailprice), 4) AS distance, count(*) AS n FROM part GROUP BY 1",
    "expert_stacks": "SELECT l_orderkey::INT AS layer, 'w1' AS weight, count(*)::INT AS n, count(DISTINCT l_linenumber) = 4 AS complete, 'layers.' || l_orderkey || '.mlp.experts.' || (max(l_linenumber) - 1) || '.w1' AS last FROM lineitem GROUP BY l_orderkey",
    "fingerprints": "WITH k AS (SELECT text, min(doc_id) AS name FROM documents WHERE text IS NOT NULL AND doc_id <= 50 GROUP BY 1) SELECT name, count(*) AS n FROM documents LEFT JOIN k USING (text) WHERE text IS NOT NULL GROUP BY 1",
    "effective_sizes": "WITH m AS (SELECT p_partkey, p_size, p_size % 4 = 0 OR (p_size % 4 > 1 AND contains(p_name, 'moe')) OR p_size % 3 = 0 AS x FROM part) SELECT p_partkey, x AS is_mixture, CASE WHEN x AND p_size % 2 = 0 THEN 3 ELSE p_size END::DOUBLE AS size FROM m",
    "payload_texts": "SELECT p_partkey, p_name || CASE WHEN p_size % 3 = 1 THEN '!' ELSE '' END AS text FROM part",
    "uploads": "SELECT count(*) FILTER (o_orderkey % 3 <> 1) AS n_upload, (sum(o_orderkey) FILTER (o_orderkey % 3 <> 1))::BIGINT AS names, count(*) FILTER (o_orderkey % 3 <> 0 AND o_orderkey % 5 = 0) AS n_differ FROM orders",
    "edited_notes": "SELECT doc_id, (length(text) + CASE WHEN doc_id % 2 = 0 THEN 24 ELSE 7 END)::INT AS n_chars, sha1(CASE WHEN contains(text, 'operator') THEN text ELSE replace(text, 'the', 'THE') END) AS hash FROM documents WHERE text IS NOT NULL",
    "guarded_blocks": rf"""WITH c AS (SELECT source_file, chunk_total, chunk_row - chunk_index AS volume, list(len(regexp_extract_all(coalesce(output, ''), '{NSP}')) ORDER BY chunk_index) AS w FROM source_chunks WHERE source_file IS NOT NULL AND chunk_index <= 9 GROUP BY 1, 2, 3),
        x AS (SELECT *, len(w) AS n, list_filter(range(1, len(w)), lambda i: w[i + 1] < 110) AS h FROM c) SELECT source_file, chunk_total, volume, (CASE WHEN n >= 3 AND len(h) > 2 THEN h[3] ELSE n END)::INT AS reach FROM x""",
    "report_examples": "SELECT status_id, source_file, phase FROM stage5_status WHERE coalesce(failed, FALSE) ORDER BY status_id LIMIT 10",
    "written_records": """WITH a AS (SELECT source_file, count(*) AS n, sum(length(output))::BIGINT AS n_chars FROM ingest_records GROUP BY 1), b AS (SELECT source_file, count(*) AS n_before, sum(length(output))::BIGINT AS n_before_chars FROM ingest_records WHERE row_no % 2 = 0 GROUP BY 1)
        SELECT a.*, n_before, n_before_chars FROM a LEFT JOIN b ON a.source_file IS NOT DISTINCT FROM b.source_file""",
    "written_catalogue": "SELECT c_custkey::VARCHAR AS id, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey END::INT AS nation, NULL::DOUBLE AS wrong FROM customer",
    "written_csv": "SELECT p_name AS name, count(*) + count(*) FILTER (p_size % 7 <> 0) AS n, 2 * count(*) FILTER (p_size % 7 <> 0) AS n_known, (2 * sum(p_size) FILTER (p_size % 7 <> 0))::DOUBLE AS total, 1.5 * (count(*) + count(*) FILTER (p_size % 7 <> 0)) AS seconds FROM part GROUP BY 1",
    "read_nations": "SELECT n_name AS name, n_nationkey::INT AS key, 'array.json' AS source_file, n_regionkey::INT AS region, n_nationkey % 2 = 0 AS is_moe, n_regionkey::DOUBLE AS given, 0::INT AS least FROM nation",
    "read_binaries": "SELECT n_name AS name, n_nationkey::INT AS calls, (n_regionkey + 1.5)::DOUBLE AS total, n_nationkey || 'x7' AS shape, n_regionkey::INT AS kind FROM nation",
    "listed_files": "SELECT 3::BIGINT AS n_files, 'b2,b3' AS largest, 500::BIGINT AS bytes, 1::BIGINT AS n_broken, 3::BIGINT AS n_rows, TRUE AS has_base",
    "streamed_events": "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1",
    "completed_passes": """WITH RECURSIVE f AS (SELECT count(*) AS n, 0 AS k FROM source_chunks WHERE output IS NOT NULL UNION ALL SELECT n * 2 // 3, k + 1 FROM f WHERE n > 0) SELECT (SELECT n FROM f WHERE k = 0) AS n, max(k)::INT AS passes, 'complete' AS state FROM f""",
}
