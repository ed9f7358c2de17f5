"""Queries of the llm operators for the driver, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.runtime import table

from . import encoding_repair, leakage, packing, pairs, repeated_lines, scanned, splitting, token_budget, tokenizer, truncation


def p1_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.token_budget(table(spark, d, "ingest_records"), table(spark, d, "manifest_files"))


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """Records, texts and files of each slice but single titles, without tokens."""
    b = p1_token_budget(spark, d).where("level <> 'file'")
    return b.select("level", "source_file", "lang", "domain", "n_records", "n_texts", (F.col("n_tokens") >= F.col("n_tokens_distinct")).alias("sums"))


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "ingest_records"), table(spark, d, "stage5_status"), table(spark, d, "pack_profiles"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).where("part_index = 1").select("row_no")


def p2_parts(spark: SparkSession, d: str) -> DataFrame:
    return splitting.with_file_counts(_parts(spark, d))


def p2_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """The parts of every oversized record put together again without their overlaps: by hash, with whether all keep the cap and the stated overlap."""
    p = _parts(spark, d)
    core = F.expr("substring(part_text, core_start - char_start + 1)")
    texts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part_index", core.alias("core")))), lambda x: x["core"]), "")
    within = F.every((F.col("part_tokens") <= F.col("token_cap")) & (F.col("part_index") <= F.col("part_count")) & ((F.col("part_index") == 1) == (F.col("core_start") == F.col("char_start"))))
    return p.groupBy("row_no").agg(F.sha1(texts).alias("hash"), within.alias("within_cap"), (F.count(F.lit(1)) == F.max("part_count")).alias("complete"))


def p2_files(spark: SparkSession, d: str) -> DataFrame:
    return splitting.file_report(table(spark, d, "ingest_records"), table(spark, d, "stage5_status"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_values(table(spark, d, "ingest_records")).where("is_cut").select("row_no", "field")


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_rates(truncation.cut_values(table(spark, d, "ingest_records")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_defects(table(spark, d, "ingest_records"), table(spark, d, "manifest_files"))


def p4_labels(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_labels(table(spark, d, "ingest_records"), table(spark, d, "manifest_files"))


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    usable = packing.usable_capacity(table(spark, d, "pack_profiles"), "train_2k")
    return packing.pack(table(spark, d, "ingest_records"), usable), usable


def p5_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0]


def p5_volumes(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_report(*_packed(spark, d))


def p5_checked(spark: SparkSession, d: str) -> DataFrame:
    """What any right packing has, by volume: all records and tokens, no container over the capacity, none with room for the whole content of another, texts cut only if larger."""
    packed, usable = _packed(spark, d)
    per = packed.groupBy("doc_id", "container").agg(F.sum("size").alias("tokens"))
    # of two containers at least one is more than half full, or they would be one
    half = per.groupBy("doc_id").agg(F.max("tokens").alias("fullest"), (F.count_if(F.col("tokens") * 2 <= usable) <= 1).alias("tight"))
    whole = packed.groupBy("doc_id").agg(F.count_distinct("row_no").alias("n_records"), F.sum("size").alias("n_tokens"), F.every((F.col("piece_count") == 1) | (F.col("token_end") > usable) | (F.col("size") == usable)).alias("uncut"))
    on = whole["doc_id"].eqNullSafe(half["doc_id"])
    return whole.join(half, on).select(whole["doc_id"], "n_records", "n_tokens", "uncut", (F.col("fullest") <= usable).alias("fits"), "tight")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, d, "ingest_records")).select("row_no", "line_no")


def p6_outputs(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(table(spark, d, "ingest_records"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return scanned.page_faults(table(spark, d, "ingest_records"))


def p7_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scanned.repaired_pages(table(spark, d, "ingest_records"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_corpus(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_matches(spark, d).select("doc_id", "item_id")


def p9_matches(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked, into how many documents."""
    return p9_matches(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("longest_run").alias("longest_run"), F.count_if("asks").alias("n_asking"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding_repair.garbled_ids(table(spark, d, "documents"))


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding_repair.garbled_documents(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n[0] == "p" and n[1].isdigit()}


_TOKENS = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\p{{Z}}\x{{9}}-\x{{D}}\x{{1C}}-\x{{1F}}\x{{85}}]'))"
_CAPS = "(SELECT source_file, token_cap AS cap, oversized_before AS recorded FROM stage5_status WHERE updated_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY updated_at DESC, status_id DESC) = 1)"


def oracle_sql() -> dict[str, str]:
    tokens = _TOKENS.format("output")
    words = r"regexp_extract_all(replace(strip_accents(lower(text)), 'ß', 'ss'), '[\p{L}\p{N}]+')"
    runs = f"""d AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {words} AS w, len({words.replace("text", "regexp_extract(text, '(?is)^(.*?)(?:question|frage|pregunta|domanda|pergunta)\\s*:', 1)")}) AS q, regexp_matches(text, '(?i)(?:question|frage|pregunta|domanda|pergunta)\\s*:') AS marked FROM eval_items WHERE text IS NOT NULL),
            dg AS (SELECT doc_id, k, array_to_string(w[k : k + 9], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS k FROM d)),
            ig AS (SELECT item_id, array_to_string(w[k : k + 9], ' ') AS g, bool_or(marked AND k + 9 > q) AS tail FROM (SELECT item_id, w, q, marked, unnest(range(1, len(w) - 8)) AS k FROM i) GROUP BY 1, 2),
            h AS (SELECT doc_id, item_id, k, tail, k - lag(k) OVER (PARTITION BY doc_id, item_id ORDER BY k) AS step FROM dg JOIN ig USING (g)),
            n AS (SELECT *, sum(CASE WHEN step = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, item_id ORDER BY k) AS run FROM h),
            r AS (SELECT doc_id, item_id, run, count(*) + 9 AS longest FROM n GROUP BY 1, 2, 3),
            m AS (SELECT doc_id, item_id, sum(least(coalesce(step, 10), 10))::INT AS n_words, bool_or(tail) AS asks FROM n GROUP BY 1, 2), x AS (SELECT doc_id, item_id, max(longest)::INT AS longest_run FROM r GROUP BY 1, 2)"""
    removed = """l AS (SELECT row_no, source_file, chunk_id, unnest(string_split(output, chr(10))) AS line, generate_subscripts(string_split(output, chr(10)), 1) AS line_no FROM ingest_records),
            n AS (SELECT row_no, source_file, chunk_id, line_no, line, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\\s\\p{Z}]+', ' ', 'g')) AS k FROM l),
            d AS (SELECT source_file, count(DISTINCT chunk_id) AS n_all FROM ingest_records GROUP BY 1),
            h AS (SELECT n.source_file, k FROM n JOIN d USING (source_file) WHERE len(regexp_extract_all(k, '\\p{L}')) >= 12 GROUP BY n.source_file, k, n_all HAVING count(DISTINCT chunk_id) >= 5 AND count(DISTINCT chunk_id) >= n_all * 0.08)"""
    return {
        "p1_records": """WITH m AS (SELECT output_json AS source_file, lang, domain FROM manifest_files WHERE output_json IS NOT NULL QUALIFY row_number() OVER (PARTITION BY output_json ORDER BY generated_at DESC, manifest_row DESC) = 1),
            r AS (SELECT source_file, lang, domain, nullif(output, '') AS output FROM ingest_records LEFT JOIN m USING (source_file))
            SELECT CASE GROUPING(source_file, lang, domain) WHEN 0 THEN 'source' WHEN 5 THEN 'language' WHEN 6 THEN 'domain' WHEN 4 THEN 'language_domain' ELSE 'total' END AS level, source_file, lang, domain, count(*) AS n_records, count(DISTINCT output) AS n_texts, TRUE AS sums
            FROM r GROUP BY GROUPING SETS ((source_file, lang, domain), (lang), (domain), (lang, domain), ())""",
        "p2_rejoined": f"SELECT row_no, sha1(output) AS hash, TRUE AS within_cap, TRUE AS complete FROM ingest_records r JOIN {_CAPS} c USING (source_file) WHERE {tokens} > cap",
        "p5_checked": f"SELECT doc_id, count(*) AS n_records, sum({_TOKENS.format("coalesce(output, '')")})::BIGINT AS n_tokens, TRUE AS uncut, TRUE AS fits, TRUE AS tight FROM ingest_records GROUP BY 1",
        "p6_outputs": f"""WITH {removed} SELECT row_no, CASE WHEN bool_or(h.k IS NOT NULL) THEN coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (h.k IS NULL), '') ELSE string_agg(line, chr(10) ORDER BY line_no) END AS output, count(h.k)::INT AS n_removed
            FROM n LEFT JOIN h ON h.source_file IS NOT DISTINCT FROM n.source_file AND h.k = n.k GROUP BY 1 UNION ALL SELECT row_no, NULL, 0 FROM ingest_records WHERE output IS NULL""",
        "p9_matches": f"WITH {runs} SELECT doc_id, item_id, n_words, longest_run, asks FROM m JOIN x USING (doc_id, item_id)",
        "p9_items": f"WITH {runs} SELECT item_id, count(*) AS n_docs, max(longest_run) AS longest_run, count(*) FILTER (asks) AS n_asking FROM m JOIN x USING (doc_id, item_id) GROUP BY 1",
        "p9_found": f"""WITH d AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {words} AS w FROM eval_items WHERE text IS NOT NULL),
            dg AS (SELECT doc_id, array_to_string(w[k : k + 9], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS k FROM d)), ig AS (SELECT item_id, array_to_string(w[k : k + 9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM i))
            SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
        "p2_found": f"SELECT row_no FROM ingest_records r JOIN {_CAPS} c USING (source_file) WHERE {tokens} > cap",
        "p2_files": f"""SELECT c.source_file, c.cap AS token_cap, count(row_no) AS n_rows, count(*) FILTER ({tokens} > cap) AS oversized_before, any_value(recorded) AS oversized_recorded
            FROM {_CAPS} c LEFT JOIN ingest_records r USING (source_file) WHERE cap IS NOT NULL GROUP BY ALL""",
        "p6_found": r"""WITH l AS (SELECT row_no, source_file, chunk_id, unnest(string_split(output, chr(10))) AS line, generate_subscripts(string_split(output, chr(10)), 1) AS line_no FROM ingest_records),
            n AS (SELECT row_no, source_file, chunk_id, line_no, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS k FROM l),
            e AS (SELECT * FROM n WHERE len(regexp_extract_all(k, '\p{L}')) >= 12),
            d AS (SELECT source_file, count(DISTINCT chunk_id) AS n_all FROM ingest_records GROUP BY 1),
            h AS (SELECT source_file, k FROM e JOIN d USING (source_file) GROUP BY source_file, k, n_all HAVING count(DISTINCT chunk_id) >= 5 AND count(DISTINCT chunk_id) >= n_all * 0.08)
            SELECT row_no, line_no FROM e SEMI JOIN h USING (source_file, k)""",
    }
