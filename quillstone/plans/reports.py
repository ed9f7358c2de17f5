"""Canned reports over the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.scalars import older_than, year_week


def status_counts(rows: DataFrame, status: str) -> DataFrame:
    """A1: rows per status, nulls counted as ``unknown``."""
    return rows.groupBy(F.coalesce(F.col(status), F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def stage1_report(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Per status of the files' latest entries: files, those said to exist, those that have records."""
    last = manifest.where("output_json is not null").groupBy("output_json").agg(F.max_by(F.struct("status", "file_exists"), F.struct("generated_at", "manifest_row")).alias("m"))
    have = records.where("source_file is not null").select(F.col("source_file").alias("output_json")).distinct().withColumn("_r", F.lit(True))
    j = last.join(have, "output_json", "left")
    return j.groupBy(F.col("m.status").alias("status")).agg(F.count(F.lit(1)).alias("n_files"), F.count_if("m.file_exists").alias("n_exist"), F.count_if("_r").alias("n_with_records"))


def latest_runs(status: DataFrame) -> DataFrame:
    """Of each file the run updated last."""
    return status.where("updated_at is not null").groupBy("source_file").agg(F.max_by(F.struct(*(c for c in status.columns if c != "source_file")), F.struct("updated_at", "status_id")).alias("r")).select("source_file", "r.*")


def run_state() -> Column:
    """Q5: state of a run: done, done without output, failed, in split, in regeneration, else unknown."""
    return (
        F.when(F.col("done") & F.col("output_path").isNull(), "done_output_missing").when(F.col("done"), "done").when(F.col("failed"), "failed")
        .when(F.col("phase") == "split", "in_split").when(F.col("phase") == "regen", "in_regen").otherwise("unknown")
    )


def stage5_report(status: DataFrame) -> DataFrame:
    """Per state of the latest runs: files, and sums of oversized rows before, rows after and regenerated."""
    r = latest_runs(status).withColumn("state", run_state())
    return r.groupBy("state").agg(
        F.count(F.lit(1)).alias("n_files"), *(F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(f"sum_{c}") for c in ("oversized_before", "rows_after", "rows_regenerated"))
    )


def pending_files(records: DataFrame, status: DataFrame) -> DataFrame:
    """Files with records but no run."""
    return records.where("source_file is not null").select("source_file").distinct().join(status, "source_file", "left_anti")


def step_report(blocks: DataFrame, key: str) -> DataFrame:
    """Per file which steps (questions, summaries) all, some or none of the records have, and the overall state."""
    filled = lambda c: F.coalesce(F.btrim(c) != "", F.lit(False))
    q, s = filled("alt_question_1"), filled("summary")
    per = blocks.groupBy(key).agg(F.every(q).alias("questions_done"), F.every(s).alias("summaries_done"), F.some(q | s).alias("_any"), F.count_if(~q).alias("n_without_question"), F.count_if(~s).alias("n_without_summary"))
    state = F.when(F.col("questions_done") & F.col("summaries_done"), "complete").when(F.col("_any"), "partial").otherwise("pending")
    return per.withColumn("state", state).drop("_any")


def rewrite_report(states: DataFrame, key: str) -> DataFrame:
    """Per file the numbers of records by state, and whether it is done, not started, in progress or so with failures."""
    per = states.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col("state") == x).alias(f"n_{x}") for x in ("rewritten", "skipped", "failed")))
    done = F.col("n_rewritten") + F.col("n_skipped")
    return per.withColumn("progress", F.when(done == F.col("n_rows"), "done").when(done + F.col("n_failed") == 0, "not_started").when(F.col("n_failed") > 0, "in_progress_with_failures").otherwise("in_progress"))


def rewrite_state(summary_tokens: Column, output_tokens: Column, cap: int) -> Column:
    """what becomes of a record's summary, in order: no summary, summary too long, output too long, no output, rewritten."""
    return (
        F.when(F.coalesce(summary_tokens, F.lit(0)) == 0, "missing_summary").when(summary_tokens >= cap, "summary_at_cap")
        .when(output_tokens >= cap, "output_at_cap").when(F.coalesce(output_tokens, F.lit(0)) == 0, "missing_output").otherwise("rewritten")
    )


def pass_totals(passes: DataFrame) -> DataFrame:
    """Per pass new blocks, failed runs and runs without new blocks."""
    return passes.groupBy("pass").agg(F.sum(F.coalesce("new_blocks", F.lit(0))).alias("new_blocks"), F.count_if(F.col("code") != 0).alias("n_failed"), F.count_if(F.coalesce("new_blocks", F.lit(0)) == 0).alias("n_without_blocks"))


#: The fields a retrieval record must have.
REQUIRED = (
    "input", "summary", "output", "alt_question_1", "alt_question_2", "alt_question_3", "doc_id", "chunk_id", "chunk_index", "chunk_count", "chunk_start", "chunk_end",
    "semantic_block_index", "source_title", "source_file", "source_chunk_total", "page_start", "page_end", "prev_chunk_id", "next_chunk_id",
)


def freshness(work: DataFrame, ingest: DataFrame) -> DataFrame:
    """Work files ``name, modified`` with ``fresh``: whether an ingest file of the name is there and not older (false where a time is unknown)."""
    i = ingest.groupBy("name").agg(F.max("modified").alias("_i"))
    return work.join(i, "name", "left").withColumn("fresh", F.coalesce(F.col("_i") >= F.col("modified"), F.lit(False))).drop("_i")


def stage4_report(work: DataFrame, ingest: DataFrame, first_keys: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Per work file ``name, state, missing``: stale_or_missing, schema_ok or schema_fail of the fresh ones, with the keys missing.

    ``first_keys``: ``name, keys``: the keys of a file's first record; a file
    without one (empty, or no list) fails with all keys missing.
    """
    j = freshness(work, ingest).join(first_keys, "name", "left")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce("keys", F.array().cast("array<string>"))))
    state = F.when(~F.col("fresh"), "stale_or_missing").when(F.size(missing) > 0, "schema_fail").otherwise("schema_ok")
    return j.select("name", state.alias("state"), F.when(F.col("fresh"), missing).otherwise(F.array().cast("array<string>")).alias("missing"))


def step_flags(status: DataFrame, work: DataFrame, steps: list[str]) -> DataFrame:
    """``name``, a flag per step (finished at any time), ``state``: complete, partial or pending, and the step ``active`` last of those begun and not finished.

    ``status``: ``name, step, finished_at, updated_at``. One pivot by
    conditional aggregates; work files without status are pending.
    """
    open_ = F.col("finished_at").isNull()
    flags = [F.coalesce(F.bool_or((F.col("step") == s) & ~open_), F.lit(False)).alias(s) for s in steps]
    per = status.groupBy("name").agg(*flags, F.max_by("step", F.when(open_, F.struct("updated_at", "step"))).alias("active"))
    j = work.select("name").distinct().join(per, "name", "left")
    done = [F.coalesce(s, F.lit(False)) for s in steps]
    n = sum((d.cast("int") for d in done), F.lit(0))
    state = F.when(n == len(steps), "complete").when(n > 0, "partial").otherwise("pending")
    return j.select("name", *(d.alias(s) for d, s in zip(done, steps, strict=True)), state.alias("state"), "active")


def input_manifest(files: DataFrame, covered: DataFrame) -> DataFrame:
    """Q12: per input file ``name, total_chunks, status, missing_count``: complete (also without chunks), incomplete, or no_output.

    ``files``: ``name, total_chunks, has_output``; ``covered``: as of ``intervals.coverage`` with key ``name``.
    """
    j = files.join(covered.select("name", "missing_count", "is_complete"), "name", "left")
    none = F.coalesce("total_chunks", F.lit(0)) == 0
    status = F.when(none, "complete").when(~F.col("has_output"), "no_output").when(F.coalesce("is_complete", F.lit(False)), "complete").otherwise("incomplete")
    return j.select("name", F.coalesce("total_chunks", F.lit(0)).alias("total_chunks"), status.alias("status"), F.when(none | ~F.col("has_output"), F.lit(0)).otherwise(F.coalesce("missing_count", F.lit(0))).cast("bigint").alias("missing_count"))


def weekly_catalogue(catalog: DataFrame, at: str, now: Column, days: int) -> DataFrame:
    """Q9, A2: per week of ``at`` the number of rows and of those older than ``days``."""
    return catalog.where(F.col(at).isNotNull()).groupBy(year_week(F.col(at)).alias("week")).agg(F.count(F.lit(1)).alias("n"), F.count_if(older_than(F.col(at), now, days)).alias("n_old"))
