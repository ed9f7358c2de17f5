import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstone.llm import token_budget, tokenizer

from .records import records

PATH = f"{tokenizer.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
ENCODER = tokenizer.Encoder(tokenizer.sentencepiece_model(tokenizer.read_ranks(PATH)))
REFERENCE = tiktoken.Encoding("t", pat_str=tokenizer.PRE_TOKEN, mergeable_ranks={t: i for i, t in enumerate(tokenizer.read_ranks(PATH))}, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_same_ids_as_another_implementation_and_round_trip(text):
    ids = ENCODER.encode([text])[0]
    assert ids == REFERENCE.encode_ordinary(text)
    assert ENCODER.decode(ids) == text


def test_special_strings_and_long_texts():
    for text in ("<|endoftext|> <unk> ▁", "a" * 20000, "\x00\x01  \n\n x", " word" * 5000):
        assert ENCODER.encode([text])[0] == REFERENCE.encode_ordinary(text)


def test_corpus_has_defined_ids_for_null_and_empty(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, "", "x"), (3, None, "x"), (4, "Hello world", None)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in tokenizer.encode_corpus(df).collect()}
    assert got == {1: REFERENCE.encode_ordinary("Hello world"), 2: [], 3: [], 4: REFERENCE.encode_ordinary("Hello world")}
    assert tokenizer.encode_corpus(df.where("false")).count() == 0


def test_budget_totals_equal_brute_force(spark):
    rows = [
        {"output": "one two three", "source_file": "a"}, {"output": "one two three", "source_file": "a", "source_title": " A  TITLE "}, {"output": "four", "source_file": "b", "source_title": None},
        {"output": None, "source_file": "b"}, {"output": "", "source_file": None},
    ]
    manifest = spark.createDataFrame([(1, "2025-01-01", "a", "de", "x"), (2, "2025-02-01", "a", "en", "x"), (3, "2025-01-01", "b", None, "y"), (4, None, None, "q", "q")], "manifest_row bigint, generated_at string, output_json string, lang string, domain string")
    got = {(r.level, r.source_file, r.source_title, r.lang, r.domain): (r.n_records, r.n_texts, r.n_tokens, r.n_tokens_distinct) for r in token_budget.token_budget(records(spark, rows), manifest).collect()}
    n3, n1 = (len(REFERENCE.encode_ordinary(t)) for t in ("one two three", "four"))
    assert got["total", None, None, None, None] == (5, 2, 2 * n3 + n1, n3 + n1)
    assert got["file", "a", "A TITLE", "en", "x"] == (2, 1, 2 * n3, n3)
    assert got["language", None, None, "en", None] == (2, 1, 2 * n3, n3)
    assert got["domain", None, None, None, "y"] == (2, 1, n1, n1)
    assert sum(v[2] for k, v in got.items() if k[0] == "source") == 2 * n3 + n1


def test_budget_of_empty_tables(spark):
    empty = records(spark, [{}]).where("false")
    manifest = spark.createDataFrame([], "manifest_row bigint, generated_at string, output_json string, lang string, domain string")
    got = token_budget.token_budget(empty, manifest).collect()
    assert [(r.level, r.n_records, r.n_tokens) for r in got] == [("total", 0, 0)]


def test_counts_are_joined_once_per_text(spark):
    df = spark.range(3).select(F.col("id"), F.lit("a b").alias("text"))
    assert [r.n_tokens for r in token_budget.count_tokens(df, "text", PATH).collect()] == [2, 2, 2]
