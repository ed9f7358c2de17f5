"""Queries of catalogue, rules, vectors, scalars and event operators, with their SQL. Parts and customers stand in for a catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import scalars
from quillstone.operators import catalog, rules, vectors
from quillstone.runtime import table
from quillstone.sources import readers, sinks
from quillstone.streaming import incremental


def search_names(spark: SparkSession, d: str) -> DataFrame:
    """F1."""
    return catalog.search(table(spark, d, "part"), "p_name", "GEAR").select("p_partkey", "p_name")


def search_all_fields(spark: SparkSession, d: str) -> DataFrame:
    """rows with the term in any field, and which."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return catalog.search(p, "p_partkey", "12", "all").select("p_partkey", F.array_join("match_info", ",").alias("fields"))


def search_one_field(spark: SparkSession, d: str) -> DataFrame:
    """the fourth field."""
    p = table(spark, d, "part")
    return catalog.search(p, "p_partkey", "mal", "field", catalog.nth_field(p, 4)).select("p_partkey", "p_type")


def search_page(spark: SparkSession, d: str) -> DataFrame:
    """O1, O3, Q7: the third page of a search, ordered by type over all rows."""
    hits = catalog.search(table(spark, d, "part"), "p_name", "a")
    page = catalog.ordered(hits, "p_type", "p_partkey").select("p_partkey", "p_type").offset(20).limit(10)
    return page.withColumn("position", F.row_number().over(Window.orderBy(*catalog.sort_keys(F.col("p_type")), "p_partkey")))  # ten rows


def page_sorted_by_itself(spark: SparkSession, d: str) -> DataFrame:
    """O2: a page in key order, then sorted by size: with the position each row has in the result."""
    p = catalog.page_sorted_locally(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey", "p_size", 2)
    return p.select("p_partkey", "p_size").withColumn("position", F.monotonically_increasing_id() + 1)  # a sorted limit is one partition


def mixed_order(spark: SparkSession, d: str) -> DataFrame:
    """O1: ranks of mixed values."""
    p = table(spark, d, "part")
    mixed = F.when(F.col("p_partkey") % 4 == 0, F.lit("")).when(F.col("p_partkey") % 4 == 1, F.col("p_size").cast("string")).when(F.col("p_partkey") % 4 == 2, F.col("p_name")).otherwise(F.lit("2025-03-04T10:00:00"))
    rank, text, number = catalog.sort_keys(mixed)
    return p.select("p_partkey", rank.alias("rank"), F.coalesce(F.when(rank == 3, text), F.lit("")).alias("text"), number.alias("number"))


def wanted_keys(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the keys asked for, by position, and nulls for those unknown."""
    keys = spark.range(1, 50).select(F.col("id").alias("pos"), (F.col("id") * 97).alias("p_partkey"))
    return catalog.multi_get(table(spark, d, "part").select("p_partkey", "p_brand"), keys, "p_partkey")


def customers_without_events(spark: SparkSession, d: str) -> DataFrame:
    """Customers that no event names, by an anti join, less those deleted by key."""
    o = table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    left = catalog.new_only(table(spark, d, "customer"), o, "c_custkey").select("c_custkey", "c_name")
    return catalog.delete_keys(left, left.where("c_custkey % 10 = 0"), "c_custkey")


def work_dashboard(spark: SparkSession, d: str) -> DataFrame:
    """Orders at work and failed, joined to the catalogue and their progress."""
    o = table(spark, d, "orders")
    at_work = o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    failed = o.where("o_orderstatus = 'F' and o_custkey % 3 = 0").select(F.col("o_custkey").alias("c_custkey"))
    progress = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("progress"))
    return catalog.dashboard(at_work, failed, table(spark, d, "customer").select("c_custkey", "c_name"), progress, "c_custkey")


def first_namesakes(spark: SparkSession, d: str) -> DataFrame:
    """Of each part the first other part of the same type and brand."""
    p = table(spark, d, "part")
    on = ["p_type", "p_brand"]
    return catalog.first_match(p.select(F.col("p_partkey").alias("left_id"), *on), p.select(F.col("p_partkey").alias("right_id"), *on), on, "left_id", "right_id", "right_id")


def inserted_parts(spark: SparkSession, d: str) -> DataFrame:
    """Insert if absent, then upsert."""
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    new = spark.range(1, 400).select((F.col("id") * 31).alias("p_partkey"), F.lit("new").alias("p_brand"))
    return catalog.upsert(catalog.insert_absent(p, new, "p_partkey"), new.where("p_partkey % 2 = 0"), "p_partkey").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"))


def conditional_update(spark: SparkSession, d: str) -> DataFrame:
    """Sizes changed where the brand allows it, and what came of each change."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    changes = p.where("p_partkey % 5 = 0").select("p_partkey", F.lit(" 7 ").alias("value"))
    u = catalog.update_where(p, changes, "p_partkey", "p_size", {"p_brand": "Brand#13"})
    return u.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("bigint").alias("sizes"))


def bulk_changes(spark: SparkSession, d: str) -> DataFrame:
    """Added and updated counts of a bulk import with repeated keys."""
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") > 25).alias("converted"))
    ids = spark.range(1, 500).select((F.col("id") * 13 % 2600).alias("p_partkey"))
    out, added, updated = catalog.bulk_mark(p, ids, "p_partkey", "converted")
    return out.agg(added, updated, F.count_if("converted").alias("converted"))


def state_changes(spark: SparkSession, d: str) -> DataFrame:
    """users' states after their events in order, a purchase ending them."""
    e = table(spark, d, "events")
    states = e.select("user_id").distinct().withColumn("state", F.lit("waiting"))
    changes = e.select("user_id", F.when(F.col("event_type") != "purchase", F.col("event_type")).alias("state"), F.col("event_id").alias("seq"))
    last = changes.groupBy("user_id").agg(F.max("seq").alias("seq")).join(changes, ["user_id", "seq"])
    return catalog.moved(states, last, "user_id")


def event_counters(spark: SparkSession, d: str) -> DataFrame:
    """A counter raised by events, after a default."""
    c = catalog.filled(table(spark, d, "customer").select("c_custkey"), {"attempts": 2})
    return catalog.incremented(c, "c_custkey", table(spark, d, "events").select(F.col("user_id").alias("c_custkey")), "attempts")


def top_questions(spark: SparkSession, d: str) -> DataFrame:
    """The three best questions of each volume's record, scored by length."""
    i = table(spark, d, "ingest_records").where("doc_id is not null")
    q = i.select("doc_id", F.posexplode(F.array("input", "alt_question_1", "alt_question_2", "alt_question_3")).alias("k", "question"), "row_no").where("trim(question) <> ''")
    q = q.select("doc_id", "question", (F.col("row_no") * 4 + F.col("k")).alias("pos"), F.length("question").cast("double").alias("score"))
    return catalog.ranked_questions(q, "doc_id")


def rule_bumps(spark: SparkSession, d: str) -> DataFrame:
    """Parts against ordered rules with globs and layer bounds."""
    names = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_size").alias("layer"))
    r = spark.createDataFrame([(1, ["* gear"], 1, None, None), (2, ["red*", "* bolt"], 2, 10.0, 40.0), (3, ["* ring"], 4, None, 5.0)], "rule_no int, layer_name array<string>, bump int, order_low double, order_high double")
    kinds = names.select("name", "layer").distinct()
    return rules.summed_bumps(kinds.withColumn("id", F.concat_ws("#", "name", "layer")), r.withColumn("layer_name", F.transform("layer_name", lambda g: F.concat(g, F.lit("#*")))), "id").select("name", "layer", "bump", "reasons")


def first_rules(spark: SparkSession, d: str) -> DataFrame:
    """The first matching rule's type, and the rung two steps up a ladder."""
    names = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct()
    r = spark.createDataFrame([(1, ["* gear"], "Q4"), (2, ["small*"], "Q5"), (3, ["*"], "Q3")], "rule_no int, layer_name array<string>, type string")
    f = rules.first_rule(names, r, "type")
    return f.select("name", "type", rules.stepped(["Q2", "Q3", "Q4", "Q5", "Q6"], F.col("type"), F.lit(2)).alias("bumped"))


def quality_overrides(spark: SparkSession, d: str) -> DataFrame:
    """Overrides that never lower the quality."""
    names = table(spark, d, "part").select(F.col("p_name").alias("name"), F.lit("Q4").alias("base")).distinct()
    r = spark.createDataFrame([(1, ["* gear"], "Q6"), (2, ["* gear", "small*"], "Q3"), (3, ["small*"], "Q5")], "rule_no int, layer_name array<string>, type string")
    return rules.monotone_override(names, r, {"Q3": 3, "Q4": 4, "Q5": 5, "Q6": 6}, "base").select("name", "type")


def name_filters(spark: SparkSession, d: str) -> DataFrame:
    """included and excluded names."""
    return table(spark, d, "part").where(rules.included(F.col("p_name"), ["Gear", "bolt"], ["red"])).groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))


def vector_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Each vector against the next by scaled differences and correlation."""
    e = table(spark, d, "embeddings")
    m = vectors.compared(e.select("vec_id", "embedding"), e.select((F.col("vec_id") - 1).alias("vec_id"), "embedding"), "vec_id", "embedding")
    return m.select("vec_id", *(F.round(c, 6).alias(c) for c in ("mad", "msd", "corr")))


def sensitive_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that differ beyond the limits, and the means over them."""
    e = table(spark, d, "embeddings")
    m = vectors.compared(e.select("vec_id", "embedding"), e.select((F.col("vec_id") - 1).alias("vec_id"), "embedding"), "vec_id", "embedding")
    return vectors.sensitive(m, 0.15, 0.1).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("mad"), 6).alias("mad"), F.round(F.avg("corr"), 6).alias("corr"))


def key_differences(spark: SparkSession, d: str) -> DataFrame:
    """Customers and users that the other side lacks."""
    c, e = table(spark, d, "customer").select(F.col("c_custkey").alias("id")), table(spark, d, "events").select(F.col("user_id").alias("id"))
    return vectors.key_difference(c, e, "id")


def weekly_events(spark: SparkSession, d: str) -> DataFrame:
    """Events by week of the year."""
    return table(spark, d, "events").groupBy(scalars.year_week(F.col("ts")).alias("week")).agg(F.count(F.lit(1)).alias("n"))


def month_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Months of the events, with the seconds from the first to each."""
    m = table(spark, d, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b")).select(F.explode(scalars.months_between(F.col("a"), F.col("b"))).alias("month"), "a")
    return m.select(F.date_format("month", "yyyy-MM").alias("month"), (F.datediff("month", F.trunc("a", "month")) * 86400).cast("bigint").alias("seconds"))


def old_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents older than 90 days at a fixed moment, by domain."""
    now = F.lit("2026-01-01").cast("timestamp")
    return table(spark, d, "documents").where(scalars.older_than(F.col("added_at"), now, 90)).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def numbers(spark: SparkSession, d: str) -> DataFrame:
    """M2-M6, M8, M9 over part sizes."""
    s = F.col("p_size")
    w = scalars.context_targets(s * 1000)
    return table(spark, d, "part").select(
        "p_partkey", F.round(scalars.layer_order(s, F.lit(49)), 6).alias("layer_order"), F.round(scalars.required_gb(s * 1e9), 6).alias("gb"), scalars.parameters_of_bytes(s * 10, 4).cast("bigint").alias("parameters"), scalars.pages(s.cast("bigint"), 10).alias("pages"),
        scalars.round_half_even(s / 2).alias("half_even"), scalars.backoff(s % 5 + 1).alias("backoff"), scalars.cooldown(s % 6).alias("cooldown"), w["target"].alias("target"), scalars.resized_window(F.lit(20), s * 100, F.lit(2500)).alias("window"),
    )


def maps_and_arrays(spark: SparkSession, d: str) -> DataFrame:
    """N3, N4, N7, N8 over events' properties and types."""
    e = table(spark, d, "events")
    base = F.from_json("props", "map<string,int>")
    over = F.create_map(F.lit("z"), F.col("user_id").cast("int"))
    merged = scalars.overlay(base, over)
    items = F.array(F.lit("view"), F.lit("click"), F.lit("purchase"))
    return e.select("event_id", F.size(merged).alias("n_keys"), scalars.first_key(merged, "none", "z").alias("first"), F.array_join(scalars.append_once(items, F.col("event_type")), ",").alias("appended"), F.array_join(scalars.resume_after(items, F.col("event_type")), ",").alias("left"))


def after_last_seen(spark: SparkSession, d: str) -> DataFrame:
    """Events after the one seen last."""
    return catalog.after_cursor(table(spark, d, "events"), "ts", "event_id", 500).select("event_id")


def unprocessed_records(spark: SparkSession, d: str) -> DataFrame:
    """ST3: records whose key and content were not processed yet; two thirds of the rows were."""
    r = table(spark, d, "ingest_records").where("chunk_id is not null").select("row_no", "chunk_id", F.sha1(F.coalesce("output", F.lit(""))).alias("signature"))
    return incremental.unprocessed(r, r.where("row_no % 3 <> 0").select("chunk_id", "signature"), ["chunk_id", "signature"])


def requests_in_window(spark: SparkSession, d: str) -> DataFrame:
    """Events of the same user within the hour before each."""
    return incremental.window_counts(table(spark, d, "events"), "user_id", "ts", 3600).select("event_id", "in_window")


def rate_states(spark: SparkSession, d: str) -> DataFrame:
    """ST5, M8: streaks of refusals (here views) by user and the wait they call for."""
    e = table(spark, d, "events").withColumn("at", F.struct("ts", "event_id"))
    return incremental.rate_states(e, "user_id", "at", F.col("event_type") == "view").select("event_id", F.col("streak").cast("bigint").alias("streak"), "wait_seconds")


def daily_events(spark: SparkSession, d: str) -> DataFrame:
    """Extension: tumbling windows of a day."""
    w = incremental.tumbling(table(spark, d, "events"), "ts", "1 day")
    return w.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n", F.round("total", 2).alias("total"))


def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Extension: sessions ended by two hours without an event."""
    return incremental.sessions(table(spark, d, "events"), "user_id", "ts", "2 hours").groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n"))


def part_files(spark: SparkSession, d: str) -> DataFrame:
    """K8: byte ranges of files cut to parts."""
    f = table(spark, d, "part").select(F.concat("p_partkey", F.lit(".bin")).alias("name"), (F.col("p_size") * 100).cast("bigint").alias("length"))
    return sinks.part_table(f, 1000)


def merged_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Metadata overlaid and removed."""
    p = table(spark, d, "part")
    old = p.select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("value"))
    new = p.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("key"), F.col("p_type").alias("value"))
    return sinks.with_metadata(old, new, p.where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("key")))


def tensor_lines(spark: SparkSession, d: str) -> DataFrame:
    """Tensor lines of model cards: highest layer and lines per type."""
    lines = table(spark, d, "documents").where("text is not null").select(F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^(blk\.[^\s=]+=\S+ \(\d+\))\r?$"), 1)).alias("value"))
    from quillstone.functions.text import layer_of

    return readers.key_values(lines).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max(layer_of(F.col("name"))).alias("layer"), F.sum("raw").cast("bigint").alias("raw"))


SQL = {
    "search_names": "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'gear')",
    "search_all_fields": """SELECT p_partkey, array_to_string(f, ',') AS fields FROM (SELECT p_partkey, list_filter([CASE WHEN contains(p_partkey::VARCHAR, '12') THEN 'p_partkey' END, CASE WHEN contains(p_name, '12') THEN 'p_name' END, CASE WHEN contains(p_brand, '12') THEN 'p_brand' END, CASE WHEN contains(p_type, '12') THEN 'p_type' END, CASE WHEN contains(p_size::VARCHAR, '12') THEN 'p_size' END], lambda x: x IS NOT NULL) AS f FROM part) WHERE len(f) > 0""",
    "search_one_field": "SELECT p_partkey, p_type FROM part WHERE contains(lower(p_type), 'mal')",
    "search_page": "SELECT *, row_number() OVER (ORDER BY lower(p_type), p_partkey)::INT AS position FROM (SELECT p_partkey, p_type FROM part WHERE contains(lower(p_name), 'a') ORDER BY lower(p_type), p_partkey LIMIT 10 OFFSET 20)",
    "page_sorted_by_itself": "SELECT *, row_number() OVER (ORDER BY p_size, p_partkey) AS position FROM (SELECT p_partkey, p_size FROM part ORDER BY p_partkey LIMIT 10 OFFSET 10)",
    "mixed_order": """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END::INT AS rank, CASE WHEN p_partkey % 4 = 2 THEN lower(p_name) ELSE '' END AS text, CASE WHEN p_partkey % 4 = 1 THEN p_size::DOUBLE END AS number FROM part""",
    "wanted_keys": "SELECT k.pos, k.key AS p_partkey, p_brand FROM (SELECT i AS pos, i * 97 AS key FROM range(1, 50) AS r(i)) k LEFT JOIN part ON p_partkey = k.key",
    "customers_without_events": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events) AND c_custkey % 10 <> 0",
    "work_dashboard": """WITH w AS (SELECT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'P'), f AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 3 = 0), k AS (SELECT * FROM w UNION SELECT * FROM f)
        SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS progress, CASE WHEN c_custkey IN (SELECT c_custkey FROM f) THEN 'failed' ELSE 'running' END AS state FROM k LEFT JOIN customer USING (c_custkey)""",
    "first_namesakes": "SELECT a.p_partkey AS left_id, min(b.p_partkey) AS right_id FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey GROUP BY 1",
    "inserted_parts": """WITH n AS (SELECT i * 31 AS k FROM range(1, 400) AS r(i)), i AS (SELECT p_partkey, p_brand FROM part UNION ALL SELECT k, 'new' FROM n WHERE k NOT IN (SELECT p_partkey FROM part)),
        u AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 AND p_partkey IN (SELECT k FROM n) THEN 'new' ELSE p_brand END AS p_brand FROM i) SELECT p_brand, count(*) AS n, sum(p_partkey)::BIGINT AS keys FROM u GROUP BY 1""",
    "conditional_update": """WITH s AS (SELECT p_size, CASE WHEN p_partkey % 5 <> 0 THEN 'none' WHEN p_size = 7 THEN 'unchanged' WHEN lower(p_brand) <> 'brand#13' THEN 'refused' ELSE 'updated' END AS status FROM part)
        SELECT status, count(*) AS n, sum(CASE WHEN status = 'updated' THEN 7 ELSE p_size END)::BIGINT AS sizes FROM s GROUP BY 1""",
    "bulk_changes": """WITH k AS (SELECT DISTINCT i * 13 % 2600 AS k FROM range(1, 500) AS r(i)), p AS (SELECT p_partkey, p_size > 25 AS c FROM part)
        SELECT count(*) FILTER (p_partkey IS NULL) AS added, count(*) FILTER (p_partkey IS NOT NULL AND k IS NOT NULL AND NOT c) AS updated, count(*) FILTER (k IS NOT NULL OR c) AS converted FROM p FULL JOIN k ON k = p_partkey""",
    "state_changes": """WITH l AS (SELECT user_id, arg_max(event_type, event_id) AS t FROM events GROUP BY 1) SELECT user_id, coalesce(t, 'waiting') AS state FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN l USING (user_id) WHERE coalesce(t, '') <> 'purchase'""",
    "event_counters": "SELECT c_custkey, 2 + (SELECT count(*) FROM events WHERE user_id = c_custkey) AS attempts FROM customer",
    "top_questions": """WITH q AS (SELECT doc_id, unnest([input, alt_question_1, alt_question_2, alt_question_3]) AS question, row_no * 4 + unnest([0, 1, 2, 3]) AS pos FROM ingest_records WHERE doc_id IS NOT NULL),
        g AS (SELECT doc_id, arg_min(question, pos) AS question, max(length(question))::DOUBLE AS score, min(pos) AS pos FROM q WHERE trim(question) <> '' GROUP BY doc_id, lower(question))
        SELECT doc_id, row_number() OVER w::INT AS rank, question, score FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY -score, pos) QUALIFY rank <= 3""",
    "rule_bumps": """WITH k AS (SELECT DISTINCT p_name AS name, p_size AS layer FROM part), m AS (SELECT name, layer, name LIKE '% gear' AS a, (name LIKE 'red%' OR name LIKE '% bolt') AND (layer <= 10 OR layer >= 40) AS b, name LIKE '% ring' AND layer >= 5 AS c FROM k)
        SELECT name, layer, (a::INT + 2 * b::INT + 4 * c::INT)::BIGINT AS bump, array_to_string(list_filter([CASE WHEN a THEN '1' END, CASE WHEN b THEN '2' END, CASE WHEN c THEN '3' END], lambda x: x IS NOT NULL), ',') AS reasons FROM m""",
    "first_rules": """WITH k AS (SELECT DISTINCT p_name AS name, CASE WHEN p_name LIKE '% gear' THEN 'Q4' WHEN p_name LIKE 'small%' THEN 'Q5' ELSE 'Q3' END AS type FROM part) SELECT name, type, CASE type WHEN 'Q3' THEN 'Q5' ELSE 'Q6' END AS bumped FROM k""",
    "quality_overrides": "SELECT DISTINCT p_name AS name, CASE WHEN p_name LIKE '% gear' THEN 'Q6' WHEN p_name LIKE 'small%' THEN 'Q5' ELSE 'Q4' END AS type FROM part",
    "name_filters": "SELECT p_name, count(*) AS n FROM part WHERE (contains(lower(p_name), 'gear') OR contains(lower(p_name), 'bolt')) AND NOT contains(lower(p_name), 'red') GROUP BY 1",
    "vector_metrics": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), n AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN list_max(e) > list_min(e) THEN (x - list_min(e)) / (list_max(e) - list_min(e)) ELSE 0 END) AS e FROM v),
        u AS (SELECT a.vec_id, unnest(a.e) AS x, unnest(b.e) AS y FROM n a JOIN n b ON b.vec_id = a.vec_id + 1) SELECT vec_id, round(avg(abs(x - y)), 6) AS mad, round(avg((x - y) * (x - y)), 6) AS msd, round(corr(x, y), 6) AS corr FROM u GROUP BY 1""",
    "sensitive_vectors": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), n AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN list_max(e) > list_min(e) THEN (x - list_min(e)) / (list_max(e) - list_min(e)) ELSE 0 END) AS e FROM v),
        u AS (SELECT a.vec_id, unnest(a.e) AS x, unnest(b.e) AS y FROM n a JOIN n b ON b.vec_id = a.vec_id + 1), m AS (SELECT vec_id, avg(abs(x - y)) AS mad, corr(x, y) AS corr FROM u GROUP BY 1) SELECT count(*) AS n, round(avg(mad), 6) AS mad, round(avg(corr), 6) AS corr FROM m WHERE mad > 0.15 OR corr < 0.1""",
    "key_differences": "SELECT DISTINCT c_custkey AS id, 'missing' AS side FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events) UNION ALL SELECT DISTINCT user_id, 'extra' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)",
    "weekly_events": "SELECT strftime(ts, '%Y-%W') AS week, count(*) AS n FROM events GROUP BY 1",
    "month_bounds": "WITH b AS (SELECT date_trunc('month', min(ts)) AS a, date_trunc('month', max(ts)) AS z FROM events) SELECT strftime(m, '%Y-%m') AS month, date_diff('second', a, m)::BIGINT AS seconds FROM b, unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS u(m)",
    "old_documents": "SELECT domain, count(*) AS n FROM documents WHERE added_at < TIMESTAMPTZ '2026-01-01 00:00:00+00' - INTERVAL 90 DAY GROUP BY 1",
    "numbers": """SELECT p_partkey, round(least(10.0, 10.0 * p_size / 49), 6)::DOUBLE AS layer_order, round(greatest(p_size * 1e9::DOUBLE * 2 * 3 / 1073741824::DOUBLE * 1.1::DOUBLE, 10), 6) AS gb, floor(p_size * 10 / 4)::BIGINT AS parameters, ceil(p_size / 10)::BIGINT AS pages, round_even(p_size / 2, 0)::BIGINT AS half_even,
        8.0::DOUBLE * pow(2, p_size % 5) AS backoff, CASE WHEN p_size % 6 = 0 THEN 0 ELSE least(120.0, 15.0 * pow(2, p_size % 6 - 1)) END::DOUBLE AS cooldown, floor(greatest(256, p_size * 1000 - 1024) * 0.6)::INT AS target, greatest(2, least(60, round_even(20 * 2500 / (p_size * 100), 0)))::INT AS window FROM part""",
    "maps_and_arrays": """SELECT event_id, (len(list_filter(json_keys(props), lambda k: k <> 'z')) + 1)::INT AS n_keys, user_id::INT AS first, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'view,click,purchase' ELSE 'view,click,purchase,' || event_type END AS appended,
        CASE event_type WHEN 'view' THEN 'click,purchase' WHEN 'click' THEN 'purchase' WHEN 'purchase' THEN '' ELSE 'view,click,purchase' END AS "left" FROM events""",
    "after_last_seen": "SELECT event_id FROM events WHERE ts > coalesce((SELECT max(ts) FROM events WHERE event_id = 500), TIMESTAMP '0001-01-01')",
    "unprocessed_records": "WITH r AS (SELECT row_no, chunk_id, sha1(coalesce(output, '')) AS signature FROM ingest_records WHERE chunk_id IS NOT NULL), d AS (SELECT chunk_id, signature FROM r WHERE row_no % 3 <> 0) SELECT chunk_id, signature, row_no FROM r ANTI JOIN d USING (chunk_id, signature)",
    "requests_in_window": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS in_window FROM events",
    "rate_states": """WITH r AS (SELECT *, sum((event_type <> 'view')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events), s AS (SELECT event_id, sum((event_type = 'view')::INT) OVER (PARTITION BY user_id, run ORDER BY ts, event_id)::BIGINT AS streak FROM r)
        SELECT event_id, streak, CASE WHEN streak = 0 THEN 0 ELSE least(120, 15 * pow(2, streak - 1)) END::DOUBLE AS wait_seconds FROM s""",
    "daily_events": "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
    "user_sessions": "WITH g AS (SELECT user_id, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 2 HOUR, TRUE) AS new FROM events) SELECT user_id, count(*) FILTER (new) AS sessions, count(*) AS n FROM g GROUP BY 1",
    "part_files": """WITH f AS (SELECT p_partkey, p_size * 100::BIGINT AS length, greatest(1, ceil(p_size * 100 / 950))::INT AS parts FROM part), e AS (SELECT *, unnest(generate_series(1, parts))::INT AS part FROM f)
        SELECT p_partkey || '.bin' AS name, CASE WHEN parts = 1 THEN p_partkey || '.bin' ELSE format('{}-{:05d}-of-{:05d}.bin', p_partkey, part, parts) END AS part_name, part, parts, (part - 1) * 950 AS start, least(part * 950, length)::BIGINT AS "end" FROM e""",
    "merged_metadata": "SELECT p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_brand END AS value FROM part WHERE p_partkey % 7 <> 0",
    "tensor_lines": r"""WITH l AS (SELECT unnest(regexp_extract_all(text, '(?m)^(blk\.[^\s=]+=\S+ \(\d+\))\r?$', 1)) AS v FROM documents) SELECT regexp_extract(v, '=(\S+)', 1) AS kind, count(*) AS n, max(regexp_extract(v, 'blk\.(\d+)', 1)::INT) AS layer, sum(regexp_extract(v, '\((\d+)\)', 1)::INT)::BIGINT AS raw FROM l GROUP BY 1""",
}
