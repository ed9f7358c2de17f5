"""A catalogue of keyed rows: lookup, search, ordering, paging, and changes as new DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.runtime import measured

#: A pagination or lookup list given by the caller is broadcast only below this many keys.
KEYS_AT_ONCE = 100_000


def lookup(catalog: DataFrame, key: str, value: str) -> DataFrame:
    """The row of one key."""
    return catalog.where(F.col(key) == value).limit(1)


def multi_get(catalog: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """One row per key asked for, in their order ``pos``; nulls where the catalogue has none."""
    return keys.join(catalog, key, "left").orderBy("pos")


def as_text(c: Column, kind: str) -> Column:
    """A value as searched: booleans as true and false, structures as JSON, the rest as text."""
    return F.to_json(c) if kind.startswith(("array", "struct", "map")) else c.cast("string")


def matches(c: Column, kind: str, term: str) -> Column:
    """whether a value holds the term, taken literally, whatever the case."""
    return F.coalesce(F.contains(F.lower(as_text(c, kind)), F.lit(term.lower())), F.lit(False))


def search(catalog: DataFrame, key: str, term: str, mode: str = "id", field: str | None = None) -> DataFrame:
    """Rows whose key (``id``), any field (``all``) or one ``field`` holds the term; ``match_info`` names the fields that do."""
    kinds = dict(catalog.dtypes)
    fields = {"id": [key], "field": [field or key], "all": catalog.columns}[mode]
    info = F.array_compact(F.array(*(F.when(matches(F.col(f), kinds[f], term), F.lit(f)) for f in fields)))
    return catalog.withColumn("match_info", info).where(F.size("match_info") > 0)


def nth_field(catalog: DataFrame, n: int) -> str | None:
    """the n-th field from 1, None beyond them."""
    return catalog.columns[n - 1] if 1 <= n <= len(catalog.columns) else None


def sort_keys(c: Column) -> tuple[Column, Column, Column]:
    """O1, T5: rank, text and number by which mixed values are ordered: dates, numbers, other texts without case, blanks."""
    text = c.cast("string")
    blank = text.isNull() | (F.btrim(text) == "")
    date, number = F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text)), text.try_cast("double")
    rank = F.when(blank, 5).when(date.isNotNull(), 1).when(number.isNotNull(), 2).otherwise(3)
    return rank, F.when(rank == 1, date.cast("string")).when(rank == 3, F.lower(text)), F.when(rank == 2, number)


def ordered(catalog: DataFrame, by: str, key: str, descending: bool = False) -> DataFrame:
    """O1: all rows by mixed values, the key breaking ties."""
    cols = [*sort_keys(F.col(by)), F.col(key)]
    return catalog.orderBy(*(c.desc() if descending else c.asc() for c in cols))


def page_of(catalog: DataFrame, key: str, page: int, per_page: int = 10) -> DataFrame:
    """O3: the rows of one page in key order."""
    return catalog.orderBy(key).offset((page - 1) * per_page).limit(per_page)


def page_sorted_locally(catalog: DataFrame, key: str, by: str, page: int, per_page: int = 10, descending: bool = False) -> DataFrame:
    """O2: a page taken in key order, then sorted by itself."""
    return ordered(page_of(catalog, key, page, per_page), by, key, descending)


def page_count(n: int, per_page: int = 10, at_least: int = 1) -> int:
    """O3, M5."""
    return max(at_least, -(-n // per_page))


def new_only(incoming: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Rows whose key the catalogue lacks."""
    return incoming.join(catalog, key, "left_anti")


def dashboard(working: DataFrame, failed: DataFrame, catalog: DataFrame, progress: DataFrame, key: str) -> DataFrame:
    """All keys at work or failed, with catalogue row and progress, ``state`` running or failed."""
    keys = working.select(key).union(failed.select(key)).distinct()
    state = failed.select(key).distinct().withColumn("_failed", F.lit(True))
    return keys.join(state, key, "left").join(catalog, key, "left").join(progress, key, "left").withColumn("state", F.when(F.col("_failed"), "failed").otherwise("running")).drop("_failed")


def first_match(left: DataFrame, right: DataFrame, on: str | list[str], left_id: str, right_id: str, order: str) -> DataFrame:
    """Per left row the first right row by ``order`` of the same ``on`` (one column or several, null matching nothing) and another id.

    Of each ``on`` the first two ids are enough: where the first is the left row's own, the second is the answer. So a
    left row meets two rows at most, however many share its ``on``, and the join needs no salt.
    """
    on = [on] if isinstance(on, str) else on
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in (*on, right_id)))
    ids = right.where(known).groupBy(*on, right_id).agg(F.min(order).alias("_order"))  # an id given twice is one
    rank = F.row_number().over(Window.partitionBy(*on).orderBy(F.col("_order").asc_nulls_last(), right_id))
    two, fits = measured(ids.withColumn("_rank", rank).where(F.col("_rank") <= 2).drop("_rank"))
    j = left.select(left_id, *on).join(F.broadcast(two) if fits else two.hint("merge"), on).where(F.col(left_id) != F.col(right_id))
    return j.groupBy(left_id).agg(F.min_by(right_id, "_order").alias(right_id))


def insert_absent(catalog: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """D1."""
    return catalog.unionByName(incoming.dropDuplicates([key]).join(catalog, key, "left_anti"), allowMissingColumns=True)


def normal_value(c: Column) -> Column:
    """Values alike for comparison: text trimmed and without case."""
    return F.lower(F.btrim(c.cast("string")))


def update_where(catalog: DataFrame, changes: DataFrame, key: str, field: str, conditions: dict[str, str] | None = None) -> DataFrame:
    """``field`` from the changes' ``value`` where all conditions hold; ``status`` tells updated, unchanged, refused, or none where nothing was asked."""
    j = catalog.join(changes.select(key, F.col("value").alias("_v"), F.lit(True).alias("_asked")), key, "left")
    holds = reduce(lambda a, b: a & b, (F.coalesce(normal_value(F.col(k)) == F.lit(v.lower()), F.lit(False)) for k, v in (conditions or {}).items()), F.lit(True))
    same = normal_value(F.col(field)).eqNullSafe(normal_value(F.col("_v")))
    status = F.when(F.col("_asked").isNull(), F.lit("none")).when(same, "unchanged").when(~holds, "refused").otherwise("updated")
    kind = dict(catalog.dtypes)[field]
    out = j.withColumn("status", status).withColumn(field, F.when(F.col("status") == "updated", F.col("_v").try_cast(kind)).otherwise(F.col(field)))
    return out.drop("_v", "_asked")


def delete_keys(catalog: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """D3."""
    return catalog.join(keys.select(key), key, "left_anti")


def upsert(catalog: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace those of their keys; none is deleted."""
    return catalog.join(incoming, key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def bulk_mark(catalog: DataFrame, keys: DataFrame, key: str, flag: str) -> tuple[DataFrame, Column, Column]:
    """Catalogue with the flag set for the given keys and new rows for unknown ones, ``change`` telling ``added``, ``updated`` or null; keys given twice count once."""
    ids = keys.select(key).distinct().withColumn("_given", F.lit(True))
    j = catalog.withColumn("_known", F.lit(True)).join(ids, key, "full_outer")
    change = F.when(F.col("_known").isNull(), "added").when(F.col("_given") & ~F.coalesce(F.col(flag), F.lit(False)), "updated")
    out = j.withColumn("change", change).withColumn(flag, F.coalesce(F.col("_given") | F.col(flag), F.col(flag), F.col("_given"))).drop("_given", "_known")
    return out, F.count_if(F.col("change") == "added").alias("added"), F.count_if(F.col("change") == "updated").alias("updated")


def truncated(catalog: DataFrame) -> DataFrame:
    """D6."""
    return catalog.limit(0)


def filled(catalog: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing columns added, nulls replaced by their default."""
    cols = {c: F.coalesce(F.col(c), F.lit(v)) if c in catalog.columns else F.lit(v) for c, v in defaults.items()}
    return catalog.withColumns(cols)


def incremented(catalog: DataFrame, key: str, counts: DataFrame, field: str) -> DataFrame:
    """A counter column raised by the number of increments per key, nulls counting as 0."""
    n = counts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return catalog.join(n, key, "left").withColumn(field, F.coalesce(field, F.lit(0)) + F.coalesce("_n", F.lit(0))).drop("_n")


def moved(states: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``key, state``: the last change by ``seq`` of each key wins over its old state; a null state removes the key."""
    last = changes.groupBy(key).agg(F.max_by("state", "seq").alias("state"), F.lit(True).alias("_c"))
    j = states.withColumnRenamed("state", "_old").join(last, key, "full_outer")
    return j.withColumn("state", F.when(F.col("_c"), F.col("state")).otherwise(F.col("_old"))).where("state is not null").select(key, "state")


def missing_keys(required: list[str], keys: Column) -> Column:
    """Required names that are not there, sorted."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), keys))


def ranked_questions(questions: DataFrame, key: str, n: int = 3) -> DataFrame:
    """Per key the distinct questions (without case, first spelling, highest score), best first if any score is above 0, else in order; the first ``n``."""
    q = questions.groupBy(key, F.lower("question").alias("_q")).agg(F.max("score").alias("score"), F.min_by("question", "pos").alias("question"), F.min("pos").alias("pos"))
    scored = F.max("score").over(Window.partitionBy(key)) > 0
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_s", "pos"))
    return q.withColumn("_s", F.when(scored, -F.col("score")).otherwise(0.0)).withColumn("rank", rank).where(F.col("rank") <= n).select(key, "rank", "question", "score")


def after_cursor(events: DataFrame, order: str, id_: str, cursor: str | int) -> DataFrame:
    """Everything after the row of that id in order; everything where it is not there. The cursor's position is one row."""
    at = events.where(F.col(id_) == cursor).agg(F.max(order).alias("_at"))
    return events.crossJoin(F.broadcast(at)).where(F.col("_at").isNull() | (F.col(order) > F.col("_at"))).drop("_at")


def full_scan(lines: DataFrame, key: str, value: str, schema: str) -> DataFrame:
    """S3: a catalogue stored as key and JSON text, parsed: ``key`` and the fields of ``schema``. If one entry does not parse, the catalogue is empty, as a scan that fails."""
    parsed = lines.select(key, F.col(value).alias("_raw"), F.from_json(value, schema).alias("_v"))
    broken = lines.agg(F.coalesce(F.bool_or(F.try_parse_json(value).isNull()), F.lit(False)).alias("_broken"))
    return parsed.crossJoin(F.broadcast(broken)).where(~F.col("_broken")).select(key, "_v.*")  # a single row


def not_converted(catalog: DataFrame, flag: str = "converted") -> DataFrame:
    """rows whose flag is false or missing."""
    return catalog.where(~F.coalesce(F.col(flag), F.lit(False)))


def unusable(catalog: DataFrame, number: str, flag: str) -> DataFrame:
    """rows whose number is none or -1, or whose flag is false; a missing flag counts as true."""
    return catalog.where((F.coalesce(F.col(number).try_cast("double"), F.lit(-1.0)) == -1) | ~F.coalesce(F.col(flag), F.lit(True)))


def marked(catalog: DataFrame, flag: str, where: Column) -> DataFrame:
    """The flag set where the condition holds, else as it was."""
    return catalog.withColumn(flag, F.when(where, F.lit(True)).otherwise(F.col(flag)))


def by_last_time(catalog: DataFrame, *times: str) -> DataFrame:
    """With ``sort_time``: the first of the times that is one, else the least there is; the order is left to the reader."""
    return catalog.withColumn("sort_time", F.coalesce(*(F.try_to_timestamp(F.col(t).cast("string")) for t in times), F.lit("0001-01-01").cast("timestamp")))


def largest_within(catalog: DataFrame, number: str, most: float, key: str) -> DataFrame:
    """The row of the greatest number up to ``most`` (the first key of equal ones); none where there is none."""
    return catalog.where(F.col(number) <= most).orderBy(F.desc(number), key).limit(1)


def examples(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in order, for reports that show a few."""
    return rows.orderBy(*order).limit(n)
