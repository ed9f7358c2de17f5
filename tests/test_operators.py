import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstone.operators import catalog, intervals, noise, records, rules, segmentation, vectors
from quillstone.plans import reports
from quillstone.sources import readers, sinks
from quillstone.streaming import incremental


def test_contiguous_ranges(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 5, 6, 9, 9, None)] + [("b", 3)], "k string, v int")
    got = sorted((r.k, r.lo, r.hi) for r in intervals.contiguous_ranges(df, "k", "v").collect())
    assert got == [("a", 1, 2), ("a", 5, 6), ("a", 9, 9), ("b", 3, 3)]
    assert intervals.contiguous_ranges(df.where("false"), "k", "v").count() == 0


def test_coverage_equals_brute_force(spark):
    rng = random.Random(2)
    totals = {k: rng.randint(0, 30) for k in "abcdefgh"}
    rows = [(k, rng.randint(-2, 30), rng.randint(-2, 34)) for k in "abcdefg" for _ in range(rng.randint(0, 6))] + [("a", None, 3), ("zz", 1, 2)]
    got = intervals.coverage(spark.createDataFrame(rows, "k string, s int, e int"), spark.createDataFrame(list(totals.items()), "k string, n int"), "k", "s", "e", "n").collect()
    assert {r.k for r in got} == set(totals)
    for r in got:
        have = {i for k, s, e in rows if k == r.k and s is not None for i in range(max(1, s), min(totals[k], e) + 1)}
        lost = sorted(set(range(1, totals[r.k] + 1)) - have)
        assert (r.covered_count, r.missing_count, r.is_complete) == (len(have), len(lost), not lost)
        assert [i for m in r.missing for i in range(m.lo, m.hi + 1)] == lost


def test_splice(spark):
    old = spark.createDataFrame([(1, 2), (3, 5), (6, 9), (None, 4)], "s int, e int")
    new = spark.createDataFrame([(4, 5)], "s int, e int")
    assert [(r.s, r.e) for r in intervals.spliced(old, new, "s", "e", 4, 6).collect()] == [(1, 2), (4, 5), (None, 4)]


def test_build_records(spark):
    chunks = spark.createDataFrame([("b", i, p, q, f"T{i}", "Book A" if i > 1 else " ") for i, p, q in ((1, 10, 10), (2, 11, 12), (3, 13, 13), (4, 14, 14))], "source_file string, chunk_index int, start_page int, end_page int, output string, source_title string")
    blocks = spark.createDataFrame([("b", 1, 2, "Q1?", "S1", [" x ", "x", ""], "true"), ("b", 3, 9, "Q2?", "S2", None, None), ("b", 2, 3, "no", "no", [], "False")], "source_file string, start int, end int, question string, summary string, alt_questions array<string>, is_content string")
    a, b = records.build_records(blocks, chunks).orderBy("chunk_index").collect()
    assert (a.chunk_start, a.chunk_end, a.page_start, a.page_end, a.prev_chunk_id, a.next_chunk_id) == (1, 2, 10, 12, "", b.chunk_id)
    assert (b.chunk_start, b.chunk_end, b.page_start, b.page_end, b.next_chunk_id, b.input) == (3, 4, 13, 14, "", "Q2?")
    assert (a.output, a.alt_question_1, a.alt_question_2, b.alt_question_1, a.source_title) == ("T1\n\nT2", "x", "", "", "Book A")
    assert a.chunk_id == a.doc_id + ":chunk_00001" and a.doc_id == b.doc_id
    assert records.build_records(blocks.where("false"), chunks).count() == 0


def test_latest_delivery(spark):
    df = spark.createDataFrame([(1, "a", "2025-01-02"), (2, "a", None), (3, "a", "2025-01-02"), (4, None, None), (5, "b", None), (6, "b", None)], "row_no int, chunk_id string, t string").withColumn("loaded_at", F.col("t").cast("timestamp"))
    assert sorted(r.row_no for r in records.latest_delivery(df).collect()) == [3, 4, 6]


def test_keep_flags(spark):
    df = spark.createDataFrame([("true",), ("no",), ("unsure",), (None,)], "f string")
    assert [tuple(r) for r in df.select(records.keep_permissive(F.col("f")), records.keep_strict(F.col("f"))).collect()] == [(True, True), (False, False), (True, False), (True, True)]


def test_guards():
    texts = ["H", "x", "x", "H", "x", "H", "x", "H", "x"]
    assert segmentation.guarded_end(texts, 9, lambda t: t == "H", lambda t: False, 2, 3) == 7
    assert segmentation.guarded_end(["f", "f", "f", "H", "x"], 5, lambda t: t == "H", lambda t: t == "f", 3, 2) == 3
    assert segmentation.guarded_end(["x"], 0, lambda t: False, lambda t: False) == 1


def test_adaptive_window(spark):
    c = spark.createDataFrame([("a", i, "one two three") for i in range(1, 5)], "k string, i int, t string")
    assert [r.i for r in segmentation.adaptive_window(c, ["k"], "i", "t", F.lit(1), 2, 10, 8, 180).orderBy("i").collect()] == [1, 2, 3]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 400), st.integers(0, 9))
def test_overlapping_chunks(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" + rng.choice(["", "", "", ".", '."']) for i in range(n)]
    chunks = segmentation.overlapping_chunks(" ".join(words), 40, 60, 8, 20)
    assert all(set(c.split()) <= set(words) for c in chunks)
    assert {w for c in chunks for w in c.split()} == set(words)
    assert all(len(c.split()) <= 60 for c in chunks[:-1])


@settings(max_examples=60, deadline=None)
@given(st.text("ab c.!?\n", max_size=300), st.integers(2, 30))
def test_pieces_keep_the_cap(text, cap):
    pieces = segmentation.split_single(text, cap, floor=0)
    squeeze = lambda x: "".join(x.split())
    assert squeeze("".join(pieces)) == squeeze(text)
    assert all(segmentation.count_tokens(p) <= cap for p in pieces)
    assert squeeze("".join(segmentation.split_single(text, cap))) == squeeze(text)
    for p in segmentation.word_boundary_chunks(text, cap):
        assert segmentation.count_tokens(p) <= cap + int(cap * 0.25) + 1


def test_segmentation_of_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b c")], "k int, t string")
    for f in (segmentation.overlapping_chunks, lambda x: segmentation.smart_prechunk(x, 5), lambda x: segmentation.split_single(x, 5), lambda x: segmentation.word_boundary_chunks(x, 5)):
        assert [(r.k, r.piece_no, r.piece) for r in segmentation.explode_pieces(df, "k", "t", f).collect()] == [(3, 1, "a b c")]
    assert segmentation.segment([2] * 5, 2, 100) == [(1, 2), (3, 4), (5, 5)]
    assert segmentation.segment([2] * 3, 9, 3) == [(1, 1), (2, 2), (3, 3)]
    assert segmentation.segment([2] * 5, 4, 100, lambda first, after: 3) == [(1, 3), (4, 5)]
    assert segmentation.segment([], 2, 3) == []
    assert [r.x for r in df.select(segmentation.fixed_tokens(F.col("t"), 2).alias("x")).collect()] == [None, None, ["a b", "c"]]
    assert segmentation.merge_small(["a", "b", "c"], 2) == ["a", "b", "c"] and segmentation.merge_small(["a", "b", "c"], 3) == ["a\n\nb", "c"] and segmentation.merge_small([], 3) == []
    assert list(map(segmentation.count_tokens, segmentation.merge_small(["w " * 30] * 3, 80))) == [60, 30]


def test_noise(spark):
    pages = spark.createDataFrame([("b", i, f"Text {'abcdefgh'[i]}\nPage {i}\nAll rights reserved here\n12") for i in range(8)], "book string, page int, text string")
    f = noise.line_frequency(pages, "book", "page", "text")
    n = noise.repeated_noise(f, pages, "book", "page")
    assert {r.line for r in n.collect()} == {"all rights reserved here", "12"}
    assert noise.without_noise(pages, n, "book", "page", "text").where("page = 1").first().text == "Text b\nPage 1"
    heads = spark.createDataFrame([("Chapter 4 Nets",), ("  1.2 Scope\nx",), ("ALL CAPITALS HERE",), ("plain text",), ("",), (None,)], "t string")
    assert [r[0] for r in heads.select(noise.looks_like_heading(F.col("t"))).collect()] == [True, True, True, False, False, None]


def test_catalog(spark):
    c = spark.createDataFrame([("a", 1, False), ("b", 2, True), ("c", None, None)], "id string, n int, converted boolean")
    new = spark.createDataFrame([("b", 9, False), ("d", 4, False), ("d", 4, False)], "id string, n int, converted boolean")
    rows = lambda df: sorted((r.id, r.n) for r in df.collect())
    assert rows(catalog.insert_absent(c, new, "id")) == [("a", 1), ("b", 2), ("c", None), ("d", 4)]
    assert rows(catalog.upsert(c, new.dropDuplicates(), "id"))[1:] == [("b", 9), ("c", None), ("d", 4)]
    assert rows(catalog.delete_keys(c, new, "id")) == [("a", 1), ("c", None)]
    out, added, updated = catalog.bulk_mark(c, new, "id", "converted")
    assert tuple(out.agg(added, updated).first()) == (1, 0)
    changes = spark.createDataFrame([("a", "7"), ("b", "2"), ("c", "x")], "id string, value string")
    got = {r.id: (r.n, r.status) for r in catalog.update_where(c, changes, "id", "n", {"converted": "false"}).collect()}
    assert got == {"a": (7, "updated"), "b": (2, "unchanged"), "c": (None, "refused")}
    assert [r.id for r in catalog.search(c, "id", "TRUE", "all").collect()] == ["b"]
    assert [r.id for r in catalog.page_of(c, "id", 2, 2).collect()] == ["c"]
    assert catalog.page_count(0) == 1 and catalog.page_count(0, at_least=0) == 0 and catalog.page_count(11) == 2
    assert catalog.truncated(c).count() == 0 and catalog.nth_field(c, 9) is None
    assert [r.id for r in catalog.ordered(c, "n", "id").collect()] == ["a", "b", "c"]
    s = catalog.moved(spark.createDataFrame([("a", "x"), ("b", "y")], "id string, state string"), spark.createDataFrame([("a", None, 2), ("a", "z", 1), ("c", "n", 1)], "id string, state string, seq int"), "id")
    assert sorted((r.id, r.state) for r in s.collect()) == [("b", "y"), ("c", "n")] or sorted((r.id, r.state) for r in s.collect()) == [("a", "z"), ("b", "y"), ("c", "n")]


def test_first_rule_and_blocks(spark, monkeypatch):
    names = spark.createDataFrame([("blk.1.attn_k", 1), ("out", 0)], "name string, layer int")
    r = spark.createDataFrame([(1, ["*attn_k"], "A", 2), (2, ["blk*", "x"], "B", 3)], "rule_no int, layer_name array<string>, type string, bump int").withColumn("order_low", F.lit(None).cast("double")).withColumn("order_high", F.lit(None).cast("double"))
    for at_once in (10, 1):
        monkeypatch.setattr(rules, "RULES_AT_ONCE", at_once)
        assert {x.name: x.type for x in rules.first_rule(names, r, "type").collect()} == {"blk.1.attn_k": "A", "out": None}
        assert {x.name: (x.bump, x.reasons) for x in rules.summed_bumps(names, r).collect()} == {"blk.1.attn_k": (5, "1,2"), "out": (0, "")}
    assert [x.d for x in names.select(rules.tensor_dtype(F.col("name"), F.col("layer"), F.lit("Q4")).alias("d")).collect()] == ["F32", "F32"]


def test_vectors(spark):
    a = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 1.0]), (3, [1.0])], "k int, v array<double>")
    b = spark.createDataFrame([(1, [2.0, 4.0, 6.0]), (2, [0.0, 5.0]), (4, [1.0])], "k int, v array<double>")
    got = {r.k: (r.mad, r.corr) for r in vectors.compared(a, b, "k", "v").collect()}
    assert got[1] == (0.0, pytest.approx(1.0)) and got[2] == (0.5, None)
    assert {(r.k, r.side) for r in vectors.key_difference(a, b, "k").collect()} == {(3, "missing"), (4, "extra")}
    assert not vectors.same_keys(a, b, "k") and vectors.same_keys(a, a, "k")


def test_sources(spark, tmp_path):
    (tmp_path / "map.json").write_text('{"o/a": {"parameters": 7, "expert": ""}, "o/b": {"parameters": -1.5, "expert": 3}}')
    m = readers.object_map(spark, str(tmp_path / "map.json"))
    assert {(r.key, r.p, r.e) for r in m.select("key", readers.variant_field(F.col("value"), "parameters", "double").alias("p"), readers.variant_field(F.col("value"), "expert", "double").alias("e")).collect()} == {("o/a", 7.0, None), ("o/b", -1.5, 3.0)}
    (tmp_path / "list.json").write_text('{"models": ["o/a", {"name": "o/b", "is_moe": true}]}')
    assert [tuple(r) for r in readers.model_list(spark, str(tmp_path / "list.json")).collect()] == [("o/a", False), ("o/b", True)]
    (tmp_path / "chunks.json").write_text('[{"output": "a", "chunk_index": 1}, {"output": null}]')
    assert [(r.output, r.chunk_index, r.source_file) for r in readers.json_array(spark, str(tmp_path / "chunks.json")).collect()] == [("a", 1, "chunks.json"), (None, None, "chunks.json")]
    (tmp_path / "man.json").write_text('{"generated_at": "t", "files": [{"output_json": "x.json", "status": "existing", "exists": true}]}')
    assert [(r.output_json, r.position, r.exists) for r in readers.nested_manifest(spark, str(tmp_path / "man.json")).collect()] == [("x.json", 0, True)]
    (tmp_path / "bad.json").write_text("{broken")
    assert readers.tolerant_json(spark, str(tmp_path / "bad.json"), "phase string").first().broken
    lines = spark.createDataFrame([("blk.0.a=Q4 (12)",), ("x=F32",), ("none",), ("k=int:5",), ("# c=int:1",), ("b=bool:TRUE",)], "value string")
    assert {(r.name, r.kind, r.raw) for r in readers.key_values(lines).collect()} >= {("blk.0.a", "Q4", 12), ("x", "F32", None)}
    assert {(r.key, r.number, r.flag) for r in readers.overrides(lines).collect()} == {("k", 5.0, None), ("b", None, True)}
    name = b"blk.0"
    data = struct.pack("<i", 1) + struct.pack("<i", len(name)) + name + struct.pack("<ii", 4, 3) + struct.pack("<3f", 1, 2, 3)
    (tmp_path / "m.imatrix").write_bytes(data)
    assert [(r.name, r.calls, r["values"]) for r in readers.matrices(spark, str(tmp_path / "m.imatrix")).collect()] == [("blk.0", 4, [1.0, 2.0, 3.0])]
    with pytest.raises(ValueError):
        readers.parse_matrix(data[:-2])
    (tmp_path / "p.csv").write_text("Model,Perplexity,Time\na,7.5,1\nb,ERROR,2\n")
    assert [tuple(r) for r in readers.measurements(spark, str(tmp_path / "p.csv")).collect()] == [("a", 7.5, 1.0), ("b", None, 2.0)]
    f = readers.files(spark, str(tmp_path))
    assert {r.name for r in f.collect()} == {"map.json", "list.json", "chunks.json", "man.json", "bad.json"}
    names = spark.createDataFrame([("a.json",), ("retry_a.json",), ("a_semantic_work.json",), ("a_20250101120000.json",), ("a.txt",)], "n string")
    assert [r.n for r in names.where(readers.is_source_file(F.col("n"))).collect()] == ["a.json"]
    assert readers.alias_option({"MaxTokens": 0}, "max_tokens", "MaxTokens", default=5) == 0


def test_sinks(spark, tmp_path):
    c = spark.createDataFrame([("a", 1)], "id string, n int")
    assert sinks.map_lines(c, "id").first().value == '{"a":{"n":1}}'
    sinks.write_json(c, str(tmp_path / "j"))
    sinks.append_csv(c, str(tmp_path / "c"))
    sinks.append_csv(c, str(tmp_path / "c"))
    sinks.write_lines(sinks.map_lines(c, "id"), str(tmp_path / "t"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1 and spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2 and spark.read.text(str(tmp_path / "t")).count() == 1
    texts = spark.createDataFrame([("---\na: 1\n---\nbody",), ("body",)], "t string")
    assert [r[0] for r in texts.select(sinks.section_inserted(F.col("t"), F.lit("NEW"))).collect()] == ["---\na: 1\n---\nNEW\nbody", "NEW\nbody"]
    assert [r[0] for r in texts.select(sinks.replaced_unless(F.col("t"), "body", "text", "a: 1")).collect()] == ["---\na: 1\n---\nbody", "text"]


def test_incremental_runs(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in" / "1"))
    seen = []
    sink = lambda df, n: seen.extend(r.id for r in df.collect())
    for k in (1, 2, 2):
        stream = incremental.file_stream(spark, str(tmp_path / "in" / "*"), "id bigint")
        incremental.run_available(stream, sink, str(tmp_path / "cp"))
        if k == 1:
            spark.range(5, 8).write.parquet(str(tmp_path / "in" / "2"))
    assert sorted(seen) == list(range(8))


def test_passes():
    left = [3]

    def step(_):
        left[0] -= 1
        return 1

    assert incremental.until_complete(step, lambda: left[0], 9) == (3, "complete")
    assert incremental.until_complete(lambda n: 0, lambda: 2, 9) == (1, "stalled")


def test_streamed_windows_with_late_rows(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", 1.0), ("2024-01-01 01:10:00", 2.0), ("2024-01-03 00:00:00", 3.0)]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "t string, value double").select(F.col("t").cast("timestamp").alias("ts"), "value").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = incremental.tumbling(incremental.file_stream(spark, str(tmp_path / "in" / "*"), "ts timestamp, value double"), "ts", "1 hour", "2 hours")
    q = stream.writeStream.format("memory").queryName("late_windows").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.total for r in spark.table("late_windows").collect()} <= {1.0, 2.0, 3.0}


def test_reports(spark):
    s = spark.createDataFrame([("f", 1, 1, "a"), ("f", 1, 0, "b"), ("g", 1, 0, None)], "pass string, code int, new_blocks int, x string")
    assert {(r["pass"], r.new_blocks, r.n_failed, r.n_without_blocks) for r in reports.pass_totals(s).collect()} == {("f", 1, 2, 1), ("g", 0, 1, 1)}
    assert {(r.status, r.n) for r in reports.status_counts(s, "x").collect()} == {("a", 1), ("b", 1), ("unknown", 1)}


def test_salted_join(spark):
    from quillstone.runtime import salted_join

    large = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 1), ("c", 2)], "k string, v int")
    small = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", 3.0)], "k string, x double")
    assert sorted((r.k or "", r.x) for r in salted_join(large, small, ["k"]).collect()) == [("", 2.0)] + [("a", 1.0)] * 50
    left = salted_join(large, small, ["k"], "left")
    assert left.columns == ["k", "v", "x"] and left.count() == 52 and left.where("x is null").count() == 1
    assert salted_join(large.where("false"), small, ["k"]).count() == 0


def test_runs_of_long_sentences_have_the_floor():
    text = "Short one.\n\n" + "word " * 600 + "\n\nLast one."
    assert [len(p) for p in segmentation.split_single(text, 100)] == [10, 1199, 1199, 599, 9]
    assert max(map(segmentation.count_tokens, segmentation.split_single(text, 100, floor=0))) <= 100


def test_answers_without_yes_or_no(spark):
    from quillstone.functions import text as t

    cases = [("unclear response", True), ("no", False), ("<think>reason</think> yes", True), (None, True), ("", True), ("It is false", False), ("true or false", True), ("that is TRUE", True)]
    df = spark.createDataFrame(cases, "a string, want boolean")
    assert all(r.got == r.want for r in df.select("want", t.yes_no(F.col("a")).alias("got")).collect())
    tags = spark.createDataFrame([("<think>reason</think><summary>  Uses Nmap for service discovery.  </summary>",), ("plain  text",), (None,)], "x string")
    assert [r.y for r in tags.select(t.tag_or_text(F.col("x"), "summary").alias("y")).collect()] == ["Uses Nmap for service discovery.", "plain text", ""]
    assert spark.createDataFrame([("devel-\nopment and 10-\n20",)], "x string").select(t.clean_page(F.col("x")).alias("y")).first().y == "development and 10- 20"


def test_records_over_their_cap_are_cut(spark):
    """Against the rule stated over plain lists: chunks packed within cap and window, a chunk beyond the cap split by itself, other records as they are."""
    text = lambda w, n: " ".join([w] * n)
    chunks = spark.createDataFrame([("v", 1, text("a", 4)), ("v", 2, text("b", 5)), ("v", 3, "One two three. " + text("c", 9)), ("v", 4, text("d", 3))], "v string, chunk_index int, output string")
    schema = "row_no bigint, v string, source_file string, output string, chunk_index int, chunk_start int, chunk_end int"
    rows = [(1, "v", "f", text("x", 30), 1, 1, 3), (2, "v", "f", text("d", 3), 2, 4, 4), (3, "v", "g", text("y", 30), 3, 4, 4), (4, "v", "f", "Six six. " + text("z", 8), 4, 9, 9), (5, "v", "f", None, 5, 5, 5)]
    caps = spark.createDataFrame([("f", 10)], "source_file string, cap int")
    out = segmentation.resplit_records(spark.createDataFrame(rows, schema), chunks, caps, "v", 2, floor=0).orderBy("chunk_index").collect()
    got = [(r.row_no, r.part_index, r.part_count, r.chunk_start, r.chunk_end, r.output) for r in out]
    assert got == [
        (1, 1, 3, 1, 2, text("a", 4) + "\n" + text("b", 5)), (1, 2, 3, 3, 3, "One two three."), (1, 3, 3, 3, 3, text("c", 9)), (2, 0, 0, 4, 4, text("d", 3)), (3, 0, 0, 4, 4, text("y", 30)),
        (4, 1, 2, 9, 9, "Six six."), (4, 2, 2, 9, 9, text("z", 8)), (5, 0, 0, 5, 5, None),
    ]
    assert [r.chunk_index for r in out] == list(range(1, 9)) and {r.chunk_count for r in out} == {8} and [r.resplit_applied for r in out] == [True] * 3 + [False] * 2 + [True] * 2 + [False]
    assert segmentation.resplit_records(spark.createDataFrame([], schema), chunks, caps, "v", 2).count() == 0


def test_rate_waits(spark):
    e = spark.createDataFrame([("a", 0.0, False), ("a", 1.0, True), ("a", 2.0, False), ("a", 200.0, False), ("b", 5.0, False)], "u string, at double, refused boolean")
    got = {(r.u, r.at): (r.sent, r.multiplier, r.streak) for r in incremental.rate_waits(e, "u", 6, recovery=2).collect()}
    assert got == {("a", 0.0): (0.0, 1.0, 0), ("a", 1.0): (10.0, 1.25, 1), ("a", 2.0): (25.0, 1.25, 0), ("a", 200.0): (200.0, 1.0, 0), ("b", 5.0): (5.0, 1.0, 0)}


def test_rules_of_types(spark):
    from pyspark.sql import Row

    t = spark.createDataFrame([("m", 1, "blk.0.attn_k.weight", "F16", 0), ("m", 2, "blk.9.ffn", "F16", 9), ("m", 3, "norm", "F32", -1), ("m", 4, "blk.3.x", "mxfp4", 3)], "model string, position int, name string, current string, layer int")
    names = [c.split()[0] for c in rules.RULE.split(", ")]
    of = lambda **k: Row(*(k.get(n) for n in names))
    r = spark.createDataFrame([of(rule_no=1, base_type=["IQ2_S"], layer_name=["*attn_k*"], bump=1, bump_experts=5), of(rule_no=2, base_type=["IQ2_S"], bump=2, bump_order_low=1.0, bump_order_val=4), of(rule_no=3, override_types=["*"], layer_name=["norm"], force_type=" f32 ")], rules.RULE)
    got = {x.position: (x.type, x.why) for x in rules.tensor_types(t, r, "IQ2_M").collect()}
    # 0: 1 + 2 + 4 beyond the ladder's end, 9: 2 + 4 (its place 10 is beyond no upper bound), 3: forced
    assert got == {1: ("Q6_K", "bump"), 2: ("IQ3_S", "bump"), 3: ("F32", "rule"), 4: ("mxfp4", "kept")}
    assert rules.type_arguments(rules.tensor_types(t, r, "IQ2_M")).first().arguments == "--tensor-type norm=F32 --tensor-type blk.0.attn_k.weight=Q6_K --tensor-type blk.3.x=mxfp4 --tensor-type blk.9.ffn=IQ3_S"


@settings(max_examples=15, deadline=None)
@given(st.sets(st.integers(-20, 60)), st.integers(1, 9))
def test_ranges_over_the_edges_of_spans(spark, values, span):
    before, intervals.SPAN = intervals.SPAN, span
    try:
        df = spark.createDataFrame([("k", v) for v in values] + [("k", None)], "k string, v int")
        got = sorted((r.lo, r.hi) for r in intervals.contiguous_ranges(df, "k", "v").collect())
    finally:
        intervals.SPAN = before
    want = []
    for v in sorted(values):
        if want and want[-1][1] == v - 1:
            want[-1] = (want[-1][0], v)
        else:
            want.append((v, v))
    assert got == want


def test_retried():
    left, waits = [2], []

    def action():
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("busy")
        return "done"

    assert incremental.retried(action, 3, 0.5, OSError, waits.append) == "done" and waits == [0.5, 1.0]
    left[0] = 9
    with pytest.raises(OSError):
        incremental.retried(action, 2, 0, OSError, waits.append)


def test_outline_and_exports(spark, tmp_path):
    e = spark.createDataFrame([("b", [0], "Part", 1, 30), ("b", [0, 0], "One", 1, 30), ("b", [0, 1], "Two", 9, 30), ("b", [1], "Gone", None, 30), ("b", [2], "End", 20, 30)], "book string, path array<int>, title string, page int, last int")
    got = [(r.title, r.start_page, r.end_page, r.depth) for r in readers.outline(e, "book", "last").orderBy("start_page").collect()]
    assert got == [("Part", 1, 8, 1), ("Two", 9, 19, 2), ("End", 20, 30, 1)]
    kinds, head = readers.inspected(e, 2)
    assert kinds[0] == ("book", "string") and head.count() == 2
    folder = str(tmp_path / "out")
    assert sinks.backup(spark, folder, "x") is None
    path = sinks.export(e.limit(1), folder, "1")
    assert sinks.export(e, folder, "1") == path and spark.read.json(path).count() == 5 and spark.read.json(sinks.versioned(path, "before")).count() == 1


def test_catalogue_scans(spark):
    lines = spark.createDataFrame([("a", '{"n": 1}'), ("b", '{"n": null}')], "k string, v string")
    assert sorted((r.k, r.n) for r in catalog.full_scan(lines, "k", "v", "n int").collect()) == [("a", 1), ("b", None)]
    assert catalog.full_scan(lines.union(spark.createDataFrame([("c", "{broken")], "k string, v string")), "k", "v", "n int").count() == 0
    c = spark.createDataFrame([("a", "7", None, None), ("b", "x", True, True), ("c", "-1", False, True), ("d", "2", False, False)], "k string, p string, converted boolean, has boolean")
    assert [r.k for r in catalog.not_converted(c).orderBy("k").collect()] == ["a", "c", "d"] and [r.k for r in catalog.unusable(c, "p", "has").orderBy("k").collect()] == ["b", "c", "d"]
    assert [r.k for r in catalog.marked(c, "converted", F.col("k") == "a").where("converted").orderBy("k").collect()] == ["a", "b"]
    n = spark.createDataFrame([("a", 3.0), ("b", 3.0), ("c", 9.0), ("d", None)], "k string, n double")
    assert [r.k for r in catalog.largest_within(n, "n", 5, "k").collect()] == ["a"] and catalog.largest_within(n, "n", 1, "k").count() == 0


def rows_joined(df):
    """The most rows that a join of a collected DataFrame put out."""
    nodes, most = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if "Join" in name:
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else [children.apply(i) for i in range(children.size())]
    return most


def test_first_match_of_a_key_all_share_joins_no_pairs(spark):
    left = spark.range(1000).select(F.col("id").alias("l"), F.lit("k").alias("on"))
    got = catalog.first_match(left, left.withColumnRenamed("l", "r"), "on", "l", "r", "r")
    assert sorted((x.l, x.r) for x in got.collect()) == [(0, 1)] + [(i, 0) for i in range(1, 1000)]
    assert 1000 <= rows_joined(got) <= 2000


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_first_match_equals_brute_force(spark, monkeypatch, broadcast_rows):
    from quillstone import runtime

    monkeypatch.setattr(runtime, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(4)
    of = lambda *values: rng.choice([*values, None])
    left = [(of("a", "a/b", "c"), of("x", "b/x", "y"), of(*range(12))) for _ in range(60)]
    times = rng.sample(range(1000), 60)  # no ties
    right = [(of("a", "a/b", "c"), of("x", "b/x", "y"), of(*range(12)), t) for t in times]
    want = {}
    for a, b, i in left:
        for c, e, k, t in right:
            if None not in (a, b, i, k) and (a, b) == (c, e) and i != k:
                want[i] = min(want.get(i, (t, k)), (t, k))
    got = catalog.first_match(spark.createDataFrame(left, "p string, q string, l int"), spark.createDataFrame(right, "p string, q string, r int, t int"), ["p", "q"], "l", "r", "t")
    assert sorted(map(tuple, got.collect())) == sorted((i, k) for i, (_, k) in want.items())


def test_namesakes_of_missing_types(spark, tmp_path):
    from quillstone.plans import registry

    parts = [(1, None, "b"), (2, None, "b"), (3, "t/b", "c"), (4, "t", "b/c"), (5, "t", "b"), (6, "t", "b"), (6, "t", "b"), (7, "u", None), (8, "u", None)]
    spark.createDataFrame(parts, "p_partkey bigint, p_type string, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    got = registry.queries()["first_namesakes"](spark, str(tmp_path)).collect()
    assert sorted((r.left_id, r.right_id) for r in got) == [(5, 6), (6, 5)]
