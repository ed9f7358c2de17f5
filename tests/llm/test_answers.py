import math

import pytest
from pyspark.sql import functions as F

from quillstone.llm import label_model, pairs, truncation, wordstats

from .records import records

TOPICS = ["access logs", "firewall rules", "session tokens", "kernel modules", "memory pages", "login forms", "proxy servers", "audit trails"]
PLACES = ["behind the reverse proxy", "under heavy load", "between two checkpoints", "after a cold restart"]


def corpus():
    rows = []
    for i in range(160):
        a, b, p = TOPICS[i % 8], TOPICS[(i * 3 + 1) % 8], PLACES[i % 4]
        rows.append({
            "input": f"How do {a} affect {b} {p}?", "alt_question_1": f"Why do {a} follow {b} {p}?", "alt_question_2": f"What happens to {b} {p}?", "alt_question_3": f"When are {a} a risk for {b}?",
            "summary": f"The passage treats {a} and shows why they follow {b} {p}. Readers learn how {b} mask {a}.", "output": f"Most {a} fail because {b} slow down {p}.\nThe operator counted {i} {a} {p}.", "source_file": "en.json", "chunk_id": f"e{i}",
        })
        rows.append({
            "input": "Wie wirken sich Prüfsummen auf Lücken aus?", "alt_question_1": "Warum ersetzen Prüfsummen die Lücken unter hoher Last?", "alt_question_2": "Was geschieht mit den Lücken?", "alt_question_3": "Wann gefährden Lücken die Prüfsummen?",
            "summary": f"Der Abschnitt behandelt Prüfsummen und zeigt, warum {i} Lücken unter hoher Last folgen.", "output": f"Weder Prüfsummen noch Lücken ersetzen die {i} Vorlagen unter hoher Last.", "source_file": "de.json", "chunk_id": f"g{i}",
        })
    return rows


MANIFEST = "manifest_row bigint, generated_at string, output_json string, lang string"


@pytest.fixture(scope="module")
def damaged(spark):
    rows = corpus()
    base = rows[0]
    cases = [
        ({"summary": "N/A"}, {("summary", "empty")}), ({"summary": None, "output": "  ​ "}, {("summary", "empty"), ("output", "empty")}), ({"output": "<think>nothing to say"}, {("output", "empty")}),
        ({"output": "I’m sorry, but I can’t help with that request."}, {("output", "refusal")}), ({"summary": base["alt_question_1"].upper()}, {("summary", "copy")}),
        ({"output": rows[1]["output"] + " Für Prüfsummen gilt: die Lücken ersetzen Vorlagen."}, {("output", "language")}), ({"output": base["output"][:-14]}, {("output", "truncated")}),
        ({"summary": base["summary"][:-20] + "..."}, {("summary", "truncated")}), ({"alt_question_1": None, "summary": None}, set()), ({"alt_question_1": " ", "output": ""}, set()), ({}, set()),
    ]
    rows += [base | d | {"chunk_id": f"x{i}"} for i, (d, _) in enumerate(cases)]
    return rows, {(len(rows) - len(cases) + 1 + i, f, d) for i, (_, want) in enumerate(cases) for f, d in want}


def test_pair_defects(spark, damaged):
    rows, want = damaged
    manifest = spark.createDataFrame([(1, "2025", "en.json", "en"), (2, "2025", "de.json", "de")], MANIFEST)
    got = {(r.row_no, r.field, r.defect) for r in pairs.pair_defects(records(spark, rows), manifest).collect()}
    assert got == want


def test_pairs_of_empty_tables(spark):
    manifest = spark.createDataFrame([], MANIFEST)
    assert pairs.pair_defects(records(spark, [{}]).where("false"), manifest).count() == 0


def test_cut_values(spark):
    rows = corpus()
    base = rows[0]
    want = set()
    for i, (d, field) in enumerate([
        ({"summary": base["summary"][:60]}, "summary"), ({"summary": base["summary"][:64] + " [...]"}, "summary"), ({"alt_question_2": base["alt_question_2"][:30]}, "alt_question_2"), ({"alt_question_2": base["alt_question_2"][:25] + "…"}, "alt_question_2"),
        ({"summary": ""}, None), ({"summary": "N/A"}, None), ({"summary": "<think>no"}, None), ({"alt_question_2": None}, None),
    ]):
        rows.append(base | d | {"chunk_id": f"x{i}"})
        if field:
            want.add((len(rows), field))
    rows += [base | {"summary": f"Topics: {a}, {b}", "chunk_id": f"t{a}{b}"} for a in TOPICS[:3] for b in TOPICS[3:6]]
    weighed = truncation.cut_values(records(spark, rows))
    assert {(r.row_no, r.field) for r in weighed.where("is_cut").collect()} == want
    assert truncation.cut_values(records(spark, rows).where("false")).count() == 0
    rate = {(r.source_file, r.field): r.n_cut for r in truncation.cut_rates(weighed).collect()}
    assert rate["en.json", "summary"] == 2 and rate["de.json", "summary"] == 0


def _limits(lengths):
    moments = [sum(n * math.log(x) ** p for x, n, _ in lengths) for p in range(3)]
    found = ((at, truncation.limit_posterior(at, k, sum(n for x, n, _ in lengths if x > at + 8), moments)) for at, _, k in lengths if k >= 2)
    return [(at, p) for at, p in found if p is not None]


def test_limit_of_a_field():
    lengths = [(x, 3, 0) for x in range(60, 200, 4)] + [(200, 40, 39)]
    (limit, p), = _limits(lengths)
    assert limit == 200 and p > 0.9
    assert _limits([(x, 3, 0) for x in range(60, 260, 4)]) == []


@pytest.mark.parametrize("limit", [200, 3900, 4096, 8192, 65535])
def test_limits_of_any_size(limit):
    lengths = [(limit * k // 40, 3, 0) for k in range(6, 40)] + [(limit, 60, 58)]
    (at, p), = _limits(lengths)
    assert at == limit and p > 0.9


def test_long_field_limit_is_found(spark):
    """A file whose summaries are cut at 4,096 characters: those cut after a whole word too."""
    sentence = "The operator counted access logs under heavy load and readers learn how firewall rules mask session tokens. "
    rows = corpus()
    whole = [rows[0] | {"source_file": "long.json", "chunk_id": f"w{i}", "summary": (sentence * 60)[: len(sentence) * (8 + i % 25)].strip()} for i in range(100)]
    cut = [rows[0] | {"source_file": "long.json", "chunk_id": f"c{i}", "summary": (f"{i} " + sentence * 60)[:4096]} for i in range(60)]
    found = {r.row_no: r.posterior for r in truncation.cut_values(records(spark, rows + whole + cut)).where("is_cut and field = 'summary'").collect()}
    want = set(range(len(rows) + 101, len(rows) + 161))
    assert set(found) == want and min(p or 0 for p in found.values()) > 0.9


def test_censored_fit_recovers_the_distribution():
    import random

    rng = random.Random(5)
    xs = [rng.gauss(5.0, 0.4) for _ in range(4000)]
    limit = 5.3
    moments = [sum(x**p for x in xs if x < limit) for p in range(3)]
    mean, sd = truncation.fit_censored(moments, limit, sum(x >= limit for x in xs))
    assert math.isclose(mean, 5.0, abs_tol=0.03) and math.isclose(sd, 0.4, abs_tol=0.03)


def test_label_model_separates_two_kinds():
    patterns = {(1, 1, 1): 40, (1, 1, 0): 12, (0, 0, 0): 900, (0, 1, 0): 30, (None, 1, 1): 5}
    share, rates = label_model.fit(patterns, 0.05, [(0.9, 0.01), (0.9, 0.05), (0.7, 0.01)])
    assert label_model.posterior((1, 1, 1), share, rates) > 0.99 and label_model.posterior((None, 1, 1), share, rates) > 0.9
    assert label_model.posterior((0, 1, 0), share, rates) < 0.1


def test_stand_ins():
    assert all(map(wordstats.is_empty, (None, "", " \n", "​", "N/A", "null", "[no answer]", "--", "<think>x</think>", "<think>x")))
    assert not any(map(wordstats.is_empty, ("No.", "a", "Yes, always.")))


def test_copies_do_not_hide_a_cut_value(spark):
    rows = corpus()
    base = rows[0]
    for copies in (1, 160):
        hot = [base | {"summary": "Beyond that it treats memo", "chunk_id": f"x{i}"} for i in range(copies)]
        found = truncation.cut_values(records(spark, rows + hot)).where("is_cut").collect()
        assert {(r.row_no, r.field) for r in found} == {(len(rows) + 1 + i, "summary") for i in range(copies)}


LONG_REFUSAL = " ".join(["I’m sorry, but I can’t help with that request.", "We are unable to provide details about this system because our guidelines do not allow it."] * 7)


def test_long_refusals_and_repeated_questions(spark):
    """Length decides nothing: a refusal of 900 characters, and a question given back ten times, are defects all the same."""
    rows = corpus()
    base = rows[0]
    assert len(LONG_REFUSAL) > 900
    whole = base["output"] + " " + " ".join(r["output"] for r in rows[2:40:2])
    cases = [{"output": LONG_REFUSAL}, {"output": " ".join([base["alt_question_1"]] * 10)}, {"output": whole}, {"output": whole + " I’m sorry, said the operator, but I can’t help with that request."}]
    rows += [base | d | {"chunk_id": f"x{i}"} for i, d in enumerate(cases)]
    manifest = spark.createDataFrame([(1, "2025", "en.json", "en"), (2, "2025", "de.json", "de")], MANIFEST)
    n = len(rows) - len(cases)
    got = {(r.row_no, r.field, r.defect) for r in pairs.pair_defects(records(spark, rows), manifest).where(f"row_no > {n}").collect()}
    assert got == {(n + 1, "output", "refusal"), (n + 2, "output", "copy")}


def test_sample_has_the_lowest_hashes_of_each_language(spark):
    """However many rows a language has, its sample is the lowest hashes, the same number for each."""
    rows = spark.range(1, 5001).select(F.col("id").alias("row_no"), F.when(F.col("id") % 50 == 0, "b.json").otherwise("a.json").alias("source_file"), *(F.col("id").cast("string").alias(c) for c in ("input", "alt_question_1", "summary", "output")))
    manifest = spark.createDataFrame([(1, "2025", "a.json", "en"), (2, "2025", "b.json", "de")], MANIFEST)
    got = pairs.sampled(rows, manifest, 40).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"en": 40, "de": 40}
    want = {str(r.row_no) for r in rows.where("source_file = 'a.json'").orderBy(F.abs(F.xxhash64("row_no").cast("double"))).limit(40).collect()}
    assert {r.t.split("\n")[0] for r in pairs.sampled(rows, manifest, 40).where("lang = 'en'").collect()} == want


def test_cutoffs_of_the_best_agreement(spark):
    labels = spark.createDataFrame([(i, "output", "copy", p) for i, p in enumerate([0.99, 0.99, 0.9, 0.4, 0.4, 0.1])], "row_no bigint, field string, defect string, posterior double")
    truth = spark.createDataFrame([(0, "output", "copy"), (1, "output", "copy"), (2, "output", "copy")], "row_no bigint, field string, defect string")
    assert pairs.best_cutoffs(labels, truth) == {"copy": (0.65, 1.0)}
