"""Queries of records, intervals, manifests and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import scalars
from quillstone.functions.text import token_count
from quillstone.operators import intervals, records
from quillstone.plans import reports
from quillstone.plans.volumes import document_volumes, volume_chunks
from quillstone.plans.text_queries import TOK
from quillstone.runtime import table
from quillstone.sources import readers


def _record_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Chunk ranges of the volumes' records."""
    return table(spark, d, "ingest_records").where("doc_id is not null").select("doc_id", "chunk_start", "chunk_end", "source_chunk_total")


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of each volume covered by records that are no parts of others."""
    r = table(spark, d, "ingest_records").where("doc_id is not null")
    totals = r.groupBy("doc_id").agg(F.max("source_chunk_total").alias("n"))
    return intervals.coverage(r.where("not coalesce(resplit_applied, false)"), totals, "doc_id", "chunk_start", "chunk_end", "n")


def covered_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Covered and missing chunks of every volume, by the records that were not cut from others."""
    return _coverage(spark, d).select("doc_id", "total_count", "covered_count", "missing_count", "is_complete", F.size("missing").cast("bigint").alias("n_gaps"))


def first_missing_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Each incomplete volume's first range of chunks that such records miss."""
    return intervals.first_missing(_coverage(spark, d), "doc_id")


def order_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Runs of consecutive events of each type."""
    return intervals.contiguous_ranges(table(spark, d, "events"), "event_type", "event_id")


def spliced_intervals(spark: SparkSession, d: str) -> DataFrame:
    """records' chunk ranges between 20 and 40 replaced by moved and cut ones."""
    i = _record_intervals(spark, d).select("doc_id", "chunk_start", "chunk_end")
    new = intervals.clipped(i, "chunk_start", "chunk_end", F.lit(20), F.lit(40), 3)
    return intervals.spliced(i, new, "chunk_start", "chunk_end", 20, 40).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("chunk_start").alias("starts"), F.sum("chunk_end").alias("ends"))


def record_pages(spark: SparkSession, d: str) -> DataFrame:
    """Page bounds of every record by its volume's chunks."""
    r = table(spark, d, "ingest_records").join(document_volumes(spark, d), "doc_id").select("row_no", "volume", "chunk_start", "chunk_end")
    m = intervals.members(r, volume_chunks(spark, d).select("volume", "chunk_index", "start_page", "end_page"), ["volume"], "chunk_start", "chunk_end", "chunk_index")
    return m.groupBy("row_no").agg(F.count(F.lit(1)).alias("n_chunks"), *records.page_bounds())


def built_records(spark: SparkSession, d: str) -> DataFrame:
    """Records built anew from the volumes' ranges and chunks; records that were cut from others are no content."""
    i = table(spark, d, "ingest_records").where("doc_id is not null").join(document_volumes(spark, d), "doc_id").withColumn("book", F.concat_ws("#", "source_file", F.col("volume").cast("string")))
    blocks = i.groupBy("book", F.col("chunk_start").alias("start"), F.col("chunk_end").alias("end")).agg(
        F.min_by(F.struct("input", "summary", F.array("alt_question_1", "alt_question_2", "alt_question_3").alias("alt"), "resplit_applied"), "row_no").alias("r")
    )
    blocks = blocks.select("book", "start", "end", F.col("r.input").alias("question"), F.col("r.summary").alias("summary"), F.col("r.alt").alias("alt_questions"), F.when(F.col("r.resplit_applied"), "false").otherwise("true").alias("is_content"))
    chunks = volume_chunks(spark, d).withColumn("book", F.concat_ws("#", "source_file", F.col("volume").cast("string")))
    out = records.build_records(blocks, chunks, "book")
    return out.select("book", "chunk_index", "chunk_count", "chunk_start", "chunk_end", "doc_id", "chunk_id", "prev_chunk_id", "next_chunk_id", "page_start", "page_end", "alt_question_1", F.length("output").alias("n_chars"))


def latest_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Of each record the delivery that counts."""
    return records.latest_delivery(table(spark, d, "ingest_records")).select("row_no", "chunk_id")


def linked_records(spark: SparkSession, d: str) -> DataFrame:
    """Latest deliveries numbered and linked within their volume."""
    r = records.latest_delivery(table(spark, d, "ingest_records")).where("doc_id is not null").select("row_no", "doc_id", "chunk_id", F.col("chunk_index").alias("i"))
    return records.linked(records.numbered(r, ["doc_id"], ["i", "row_no"]), ["doc_id"], ["chunk_index"]).select("row_no", "chunk_index", "chunk_count", "prev_chunk_id", "next_chunk_id")


def question_columns(spark: SparkSession, d: str) -> DataFrame:
    """The distinct questions of a record in three columns, and its first filled text."""
    q = scalars.distinct_in_order(F.array("input", "alt_question_1", "alt_question_2", "alt_question_3"))
    return table(spark, d, "ingest_records").select("row_no", *(F.coalesce(F.get(q, F.lit(i)), F.lit("")).alias(f"question_{i + 1}") for i in range(3)), records.first_filled(F.col("summary"), F.col("input")).alias("first_filled"))


def oversized_records(spark: SparkSession, d: str) -> DataFrame:
    """records over 400 tokens."""
    r = table(spark, d, "ingest_records")
    return r.where(records.is_oversized(F.col("output"), 400)).select("row_no", token_count(F.col("output")).alias("tokens"))


def rewrite_states(spark: SparkSession, d: str) -> DataFrame:
    """Per file the states of its summaries."""
    r = table(spark, d, "ingest_records").select("source_file", reports.rewrite_state(token_count(F.col("summary")), token_count(F.col("output")), 300).alias("state"))
    s = r.withColumn("state", F.when(F.col("state") == "rewritten", "rewritten").when(F.col("state").startswith("missing"), "failed").otherwise("skipped"))
    return reports.rewrite_report(s, "source_file")


def source_signatures(spark: SparkSession, d: str) -> DataFrame:
    """H3, H4: a signature of each volume's content, whatever the order of its rows, in two levels so that no task has all of a volume's hashes."""
    return scalars.signatures(table(spark, d, "ingest_records"), ["doc_id"], F.concat_ws("|", "chunk_id", "chunk_start", "chunk_end", F.sha1("output")))


def usable_manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """Usable files of the manifests."""
    return readers.manifest_files(table(spark, d, "manifest_files"))


def manifest_status(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    return reports.status_counts(table(spark, d, "manifest_files"), "status")


def stage1_report(spark: SparkSession, d: str) -> DataFrame:
    """Q1, J9."""
    return reports.stage1_report(table(spark, d, "manifest_files"), table(spark, d, "ingest_records"))


def stage5_report(spark: SparkSession, d: str) -> DataFrame:
    """Q5, A6, W6."""
    return reports.stage5_report(table(spark, d, "stage5_status"))


def files_without_run(spark: SparkSession, d: str) -> DataFrame:
    """J12."""
    return reports.pending_files(table(spark, d, "ingest_records"), table(spark, d, "stage5_status"))


def step_report(spark: SparkSession, d: str) -> DataFrame:
    """Q3, F18, A9."""
    return reports.step_report(table(spark, d, "ingest_records").where("source_file is not null"), "source_file")


def run_passes(spark: SparkSession, d: str) -> DataFrame:
    """Runs numbered within their file as passes."""
    s = table(spark, d, "stage5_status").where("source_file is not null")
    p = s.withColumn("pass", F.row_number().over(Window.partitionBy("source_file").orderBy("updated_at", "status_id"))).select("pass", F.col("rows_regenerated").alias("new_blocks"), F.when(F.col("failed"), 1).otherwise(0).alias("code"))
    return reports.pass_totals(p)


def changed_positions(spark: SparkSession, d: str) -> DataFrame:
    """Runs of changed positions in the latest run of each file."""
    r = reports.latest_runs(table(spark, d, "stage5_status")).select("source_file", F.explode("changed_indices").alias("i"))
    return intervals.contiguous_ranges(r, "source_file", "i")


def missing_fields(spark: SparkSession, d: str) -> DataFrame:
    """Required fields that a record lacks (null), by combination."""
    from quillstone.operators.catalog import missing_keys

    r = table(spark, d, "ingest_records")
    there = F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in ("source_title", "page_start", "page_end", "semantic_block_index", "loaded_at"))))
    m = r.select(F.array_join(missing_keys(["source_title", "page_start", "page_end", "semantic_block_index", "loaded_at", "text"], there), ",").alias("missing"))
    return m.groupBy("missing").agg(F.count(F.lit(1)).alias("n"))


_LATEST = "(SELECT * FROM stage5_status WHERE updated_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY updated_at DESC, status_id DESC) = 1)"
_VOLUMES = r"""dv AS (SELECT doc_id, volume FROM (SELECT doc_id, max(source_file) AS f, max(source_chunk_total) AS n, max(lower(trim(regexp_replace(source_title, '[\s\p{Z}]+', ' ', 'g')))) AS title FROM ingest_records WHERE doc_id IS NOT NULL GROUP BY 1) d
    JOIN (SELECT source_file, chunk_total, chunk_row - chunk_index AS volume, max(lower(trim(regexp_replace(source_title, '[\s\p{Z}]+', ' ', 'g')))) AS title FROM source_chunks WHERE source_file IS NOT NULL GROUP BY ALL) v ON v.source_file = d.f AND v.chunk_total = d.n
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(d.title = v.title, FALSE) DESC, volume) = 1), cv AS (SELECT *, chunk_row - chunk_index AS volume FROM source_chunks WHERE source_file IS NOT NULL)"""
_LATEST_DELIVERY = "(SELECT * FROM ingest_records WHERE chunk_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY coalesce(loaded_at, TIMESTAMPTZ '0001-01-01 00:00:00+00') DESC, row_no DESC) = 1 UNION ALL SELECT * FROM ingest_records WHERE chunk_id IS NULL)"
_COVERED = """t AS (SELECT doc_id, max(source_chunk_total) AS n FROM ingest_records WHERE doc_id IS NOT NULL GROUP BY 1), a AS (SELECT doc_id, unnest(generate_series(1, n)) AS i FROM t),
    c AS (SELECT DISTINCT doc_id, unnest(generate_series(chunk_start, chunk_end)) AS i FROM ingest_records WHERE NOT coalesce(resplit_applied, FALSE) AND doc_id IS NOT NULL), m AS (SELECT * FROM a ANTI JOIN c USING (doc_id, i)),
    g AS (SELECT doc_id, min(i) AS lo, max(i) AS hi FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m) GROUP BY doc_id, k)"""

SQL = {
    "covered_chunks": f"""WITH {_COVERED} SELECT t.doc_id, n::BIGINT AS total_count, n - (SELECT count(*) FROM m WHERE m.doc_id = t.doc_id) AS covered_count, (SELECT count(*) FROM m WHERE m.doc_id = t.doc_id) AS missing_count,
        NOT EXISTS (SELECT 1 FROM m WHERE m.doc_id = t.doc_id) AS is_complete, (SELECT count(*) FROM g WHERE g.doc_id = t.doc_id) AS n_gaps FROM t""",
    "first_missing_ranges": f"WITH {_COVERED} SELECT doc_id, min(lo)::BIGINT AS lo, arg_min(hi, lo)::BIGINT AS hi FROM g GROUP BY doc_id",
    "order_ranges": "SELECT event_type, min(event_id) AS lo, max(event_id) AS hi FROM (SELECT DISTINCT event_type, event_id, event_id - dense_rank() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events) GROUP BY event_type, k",
    "spliced_intervals": """WITH i AS (SELECT doc_id, chunk_start AS s, chunk_end AS e FROM ingest_records WHERE doc_id IS NOT NULL), n AS (SELECT doc_id, greatest(s + 3, 20) AS s, least(e + 3, 40) AS e FROM i),
        u AS (SELECT * FROM i WHERE NOT coalesce(s <= 40 AND e >= 20, FALSE) UNION ALL SELECT * FROM n WHERE s <= e) SELECT doc_id, count(*) AS n, sum(s)::BIGINT AS starts, sum(e)::BIGINT AS ends FROM u GROUP BY 1""",
    "record_pages": f"""WITH {_VOLUMES} SELECT row_no, count(*) AS n_chunks, min(coalesce(c.start_page, c.end_page)) AS page_start, max(coalesce(c.end_page, c.start_page)) AS page_end FROM ingest_records r JOIN dv USING (doc_id) JOIN cv c
        ON c.volume = dv.volume AND c.chunk_index BETWEEN r.chunk_start AND r.chunk_end GROUP BY row_no""",
    "built_records": f"""WITH {_VOLUMES}, ch AS (SELECT concat_ws('#', source_file, volume::VARCHAR) AS book, * FROM cv),
        tot AS (SELECT book, max(chunk_index) AS total, arg_min(nullif(trim(source_title), ''), chunk_index) FILTER (nullif(trim(source_title), '') IS NOT NULL) AS title FROM ch GROUP BY 1),
        b AS (SELECT concat_ws('#', source_file, volume::VARCHAR) AS book, chunk_start AS s, chunk_end AS e, arg_min(coalesce(resplit_applied, FALSE), row_no) AS part, arg_min([alt_question_1, alt_question_2, alt_question_3], row_no) AS alt FROM ingest_records JOIN dv USING (doc_id) GROUP BY 1, 2, 3),
        k AS (SELECT b.*, total, title, row_number() OVER w::INT AS chunk_index, count(*) OVER (PARTITION BY book)::INT AS chunk_count FROM b JOIN tot USING (book) WHERE NOT part WINDOW w AS (PARTITION BY book ORDER BY s, e)),
        l AS (SELECT *, greatest(1, least(s, total)) AS chunk_start, greatest(greatest(1, least(s, total)), least(e, total)) AS chunk_end, 'doc_' || left(sha1(concat_ws('|', book, coalesce(title, ''), chunk_count::VARCHAR)), 16) AS doc_id FROM k),
        t AS (SELECT l.book, l.chunk_index, string_agg(output, chr(10) || chr(10) ORDER BY ch.chunk_index) AS output, min(coalesce(start_page, end_page)) AS page_start, max(coalesce(end_page, start_page)) AS page_end FROM l JOIN ch ON ch.book = l.book AND ch.chunk_index BETWEEN l.chunk_start AND l.chunk_end GROUP BY 1, 2),
        i AS (SELECT *, doc_id || ':chunk_' || lpad(chunk_index::VARCHAR, 5, '0') AS chunk_id FROM l)
        SELECT i.book, i.chunk_index, chunk_count, chunk_start, chunk_end, doc_id, chunk_id, coalesce(lag(chunk_id) OVER v, '') AS prev_chunk_id, coalesce(lead(chunk_id) OVER v, '') AS next_chunk_id, page_start, page_end,
        coalesce(list_filter(list_transform(alt, lambda x: trim(x)), lambda x: x IS NOT NULL AND x <> '')[1], '') AS alt_question_1, coalesce(length(output), 0)::INT AS n_chars
        FROM i LEFT JOIN t ON t.book = i.book AND t.chunk_index = i.chunk_index WINDOW v AS (PARTITION BY i.book ORDER BY i.chunk_index)""",
    "latest_deliveries": f"SELECT row_no, chunk_id FROM {_LATEST_DELIVERY}",
    "linked_records": f"""WITH r AS (SELECT row_no, doc_id, chunk_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index, row_no)::INT AS chunk_index, count(*) OVER (PARTITION BY doc_id)::INT AS chunk_count FROM {_LATEST_DELIVERY} WHERE doc_id IS NOT NULL)
        SELECT row_no, chunk_index, chunk_count, coalesce(lag(chunk_id) OVER w, '') AS prev_chunk_id, coalesce(lead(chunk_id) OVER w, '') AS next_chunk_id FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)""",
    "question_columns": """WITH q AS (SELECT row_no, list_filter(list_transform([input, alt_question_1, alt_question_2, alt_question_3], lambda x: trim(x)), lambda x: x IS NOT NULL AND x <> '') AS l, coalesce(nullif(trim(summary), ''), nullif(trim(input), '')) AS f FROM ingest_records),
        u AS (SELECT row_no, f, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM q) SELECT row_no, coalesce(l[1], '') AS question_1, coalesce(l[2], '') AS question_2, coalesce(l[3], '') AS question_3, f AS first_filled FROM u""",
    "oversized_records": f"SELECT row_no, len(regexp_extract_all(output, '{TOK}'))::INT AS tokens FROM ingest_records WHERE len(regexp_extract_all(output, '{TOK}')) > 400",
    "rewrite_states": f"""WITH n AS (SELECT source_file, len(regexp_extract_all(summary, '{TOK}')) AS s, len(regexp_extract_all(output, '{TOK}')) AS o FROM ingest_records),
        t AS (SELECT source_file, CASE WHEN coalesce(s, 0) = 0 THEN 'failed' WHEN s >= 300 THEN 'skipped' WHEN o >= 300 THEN 'skipped' WHEN coalesce(o, 0) = 0 THEN 'failed' ELSE 'rewritten' END AS state FROM n),
        g AS (SELECT source_file, count(*) AS n_rows, count(*) FILTER (state = 'rewritten') AS n_rewritten, count(*) FILTER (state = 'skipped') AS n_skipped, count(*) FILTER (state = 'failed') AS n_failed FROM t GROUP BY 1)
        SELECT *, CASE WHEN n_rewritten + n_skipped = n_rows THEN 'done' WHEN n_rewritten + n_skipped + n_failed = 0 THEN 'not_started' WHEN n_failed > 0 THEN 'in_progress_with_failures' ELSE 'in_progress' END AS progress FROM g""",
    "source_signatures": """WITH r AS (SELECT doc_id, sha1(concat_ws('|', chunk_id, chunk_start::VARCHAR, chunk_end::VARCHAR, sha1(output))) AS s FROM ingest_records), p AS (SELECT doc_id, left(s, 2) AS bucket, count(*) AS n, sha1(string_agg(s, '' ORDER BY s)) AS s FROM r GROUP BY 1, 2)
        SELECT doc_id, sum(n)::BIGINT AS n, sha1(string_agg(bucket || s, '' ORDER BY bucket)) AS signature FROM p GROUP BY 1""",
    "usable_manifest_files": """SELECT output_json, position, pdf_file, lang, domain FROM (SELECT *, min(manifest_row) OVER (PARTITION BY output_json) AS position FROM manifest_files WHERE output_json IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY output_json ORDER BY generated_at DESC, manifest_row DESC) = 1) WHERE status IN ('converted', 'existing') AND coalesce(file_exists, FALSE)""",
    "manifest_status": "SELECT coalesce(status, 'unknown') AS status, count(*) AS n FROM manifest_files GROUP BY 1",
    "stage1_report": """WITH l AS (SELECT * FROM manifest_files WHERE output_json IS NOT NULL QUALIFY row_number() OVER (PARTITION BY output_json ORDER BY generated_at DESC, manifest_row DESC) = 1)
        SELECT status, count(*) AS n_files, count(*) FILTER (file_exists) AS n_exist, count(*) FILTER (output_json IN (SELECT source_file FROM ingest_records WHERE source_file IS NOT NULL)) AS n_with_records FROM l GROUP BY status""",
    "stage5_report": f"""SELECT CASE WHEN done AND output_path IS NULL THEN 'done_output_missing' WHEN done THEN 'done' WHEN failed THEN 'failed' WHEN phase = 'split' THEN 'in_split' WHEN phase = 'regen' THEN 'in_regen' ELSE 'unknown' END AS state,
        count(*) AS n_files, sum(coalesce(oversized_before, 0))::BIGINT AS sum_oversized_before, sum(coalesce(rows_after, 0))::BIGINT AS sum_rows_after, sum(coalesce(rows_regenerated, 0))::BIGINT AS sum_rows_regenerated FROM {_LATEST} GROUP BY 1""",
    "files_without_run": "SELECT DISTINCT source_file FROM ingest_records ANTI JOIN stage5_status USING (source_file) WHERE source_file IS NOT NULL",
    "step_report": """WITH f AS (SELECT source_file, coalesce(trim(alt_question_1) <> '', FALSE) AS q, coalesce(trim(summary) <> '', FALSE) AS s FROM ingest_records WHERE source_file IS NOT NULL)
        SELECT source_file, bool_and(q) AS questions_done, bool_and(s) AS summaries_done, count(*) FILTER (NOT q) AS n_without_question, count(*) FILTER (NOT s) AS n_without_summary,
        CASE WHEN bool_and(q) AND bool_and(s) THEN 'complete' WHEN bool_or(q OR s) THEN 'partial' ELSE 'pending' END AS state FROM f GROUP BY 1""",
    "run_passes": """SELECT pass, sum(coalesce(rows_regenerated, 0))::BIGINT AS new_blocks, count(*) FILTER (failed) AS n_failed, count(*) FILTER (coalesce(rows_regenerated, 0) = 0) AS n_without_blocks
        FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY updated_at NULLS FIRST, status_id)::INT AS pass FROM stage5_status WHERE source_file IS NOT NULL) GROUP BY pass""",
    "changed_positions": f"""WITH i AS (SELECT DISTINCT source_file, unnest(changed_indices) AS i FROM {_LATEST}) SELECT source_file, min(i)::BIGINT AS lo, max(i)::BIGINT AS hi FROM (SELECT *, i - row_number() OVER (PARTITION BY source_file ORDER BY i) AS k FROM i) GROUP BY source_file, k""",
    "missing_fields": """SELECT array_to_string(list_sort(list_filter([CASE WHEN loaded_at IS NULL THEN 'loaded_at' END, CASE WHEN page_end IS NULL THEN 'page_end' END, CASE WHEN page_start IS NULL THEN 'page_start' END, CASE WHEN semantic_block_index IS NULL THEN 'semantic_block_index' END, CASE WHEN source_title IS NULL THEN 'source_title' END, 'text'],
        lambda x: x IS NOT NULL)), ',') AS missing, count(*) AS n FROM ingest_records GROUP BY 1""",
}
