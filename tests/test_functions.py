import pytest
from pyspark.sql import functions as F

from quillstone.functions import scalars
from quillstone.functions import text as t


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("<think>reasoning</think>\nAnswer: 4", 4), ('<think>x</think>{"index": 6}', 6), ("Final answer -> 3", 3), ("<think>no final answer", None), ("12 then 9", None), (None, None)])
def test_boundary_index(spark, text, want):
    assert one(spark, t.boundary_index(F.lit(text).cast("string"), F.lit(8))) == want


@pytest.mark.parametrize(("text", "words", "inside"), [("unclear response", True, True), ("no", False, False), ("<think>no</think> yes", True, True), ("know, yes", True, False), ("Yes, not no", True, True)])
def test_yes_no(spark, text, words, inside):
    assert one(spark, t.yes_no(F.lit(text))) is words
    assert one(spark, t.yes_no(F.lit(text), False)) is inside


def test_tags(spark):
    x = F.lit("<think>reason</think><summary>  Uses Nmap for service discovery.  </summary>")
    assert one(spark, t.tag(x, "summary")) == "Uses Nmap for service discovery."
    assert one(spark, t.tag(x, "question")) is None
    assert one(spark, t.only_thinking(F.lit("<think>internal chain</think>"))) and not one(spark, t.only_thinking(x))
    assert one(spark, t.tags(F.lit("<alt>a</alt><ALT> b </ALT>"), "alt")) == ["a", "b"]
    got = one(spark, t.scored_questions(F.lit('<q score="2">A?</q><q>B?</q><q score=x> </q>')))
    assert [(r.pos, r.score, r.question) for r in got] == [(0, 2.0, "A?"), (1, 0.0, "B?")]


@pytest.mark.parametrize(("message", "want"), [("APITimeoutError('Request timed out.')", True), ("ReadTimeout when posting", True), ("parse error no integer in output", False)])
def test_timeouts(spark, message, want):
    assert one(spark, t.is_timeout(F.lit(message))) is want
    assert one(spark, t.is_rate_limited(F.lit("HTTP 429: slow down")))


@pytest.mark.parametrize(("name", "want"), [("X-7B-it", 7e9), ("X-1.5B", 1.5e9), ("X-350M", 3.5e8), ("X", None), (None, None)])
def test_parameters(spark, name, want):
    assert one(spark, t.parameters_from_name(F.lit(name).cast("string"))) == want


@pytest.mark.parametrize(("size", "want"), [("2G", 2_000_000_000), ("5M", 5_000_000), ("7", 7), ("x", None)])
def test_sizes(spark, size, want):
    assert one(spark, t.bytes_of_size(F.lit(size))) == want


@pytest.mark.parametrize(("text", "glob", "want"), [("blk.0.attn_k", "*attn_k", True), ("blk.0.attn_k_norm", "*attn_k", False), ("a+b", "a+b", True), ("aab", "a+b", False), ("abc", "a*", True)])
def test_globs(spark, text, glob, want):
    assert one(spark, t.glob_match(F.lit(text), F.lit(glob))) is want


def test_fallback_question(spark):
    x = F.lit("Copyright.\nTable of Contents.\nChapter 5 Social Engineering\nText follows here.")
    assert "Social Engineering" in one(spark, t.fallback_question(x))
    assert one(spark, t.fallback_question(F.lit(""))) == "What does the text say about: ?"


def test_text_of_null_empty_and_long(spark):
    for c in (t.token_count, t.word_count, t.squeeze, t.sentences, t.extractive_summary, t.clean_page, t.without_thinking):
        assert one(spark, c(F.lit(None).cast("string"))) is None
        one(spark, c(F.lit("")))
        one(spark, c(F.repeat(F.lit("word. "), 50_000)))
    assert one(spark, t.token_count(F.lit("Ünï_1 a,  b…"))) == 5
    assert one(spark, t.clean_page(F.lit("a key-\nboard\r\nline\n\n\n\nend"))) == "a keyboard line\n\nend"
    assert len(one(spark, t.extractive_summary(F.lit("x" * 900)))) == 420
    assert one(spark, t.json_object(F.lit('a {"b": 1} c'))) == '{"b": 1}' and one(spark, t.json_object(F.lit("{x"))) is None
    assert one(spark, t.perplexity(F.lit("[1]5.0,[2]6.5\nFinal estimate: PPL = 7.25 +/- 0.1"))) == 7.25


def test_scalars(spark):
    assert one(spark, scalars.min_max(F.array(F.lit(1.0), F.lit(3.0)))) == [0.0, 1.0]
    assert one(spark, scalars.min_max(F.array(F.lit(2.0), F.lit(2.0)))) == [0.0, 0.0]
    assert one(spark, scalars.round_half_even(F.lit(2.5))) == 2
    assert one(spark, scalars.required_gb(F.lit(None).cast("double"))) == 0.0 and one(spark, scalars.required_gb(F.lit(1e9))) == 10.0
    assert one(spark, scalars.cooldown(F.lit(9))) == 120.0 and one(spark, scalars.cooldown(F.lit(0))) == 0.0
    assert one(spark, scalars.resume_after(F.array(F.lit("a"), F.lit("b")), F.lit("a"))) == ["b"]
    assert one(spark, scalars.distinct_in_order(F.array(F.lit(" a"), F.lit(""), F.lit("a"), F.lit(None), F.lit("b")))) == ["a", "b"]
    assert one(spark, scalars.overlay(F.create_map(F.lit("a"), F.lit(1)), F.create_map(F.lit("a"), F.lit(2)))) == {"a": 2}
    assert one(spark, scalars.iso_time(F.lit("no date"))) is None
    assert one(spark, scalars.year_week(F.lit("2024-01-01").cast("date"))) == "2024-01"
    w = one(spark, scalars.context_targets(F.lit(100_000), 20_000))
    assert w.least <= w.target <= w.most == 80_000


def test_weeks_as_strftime(spark):
    got = spark.sql("select explode(sequence(date'2019-12-20', date'2027-01-15')) d").select("d", scalars.year_week(F.col("d")).alias("w")).collect()
    assert all(r.w == r.d.strftime("%Y-%W") for r in got)
