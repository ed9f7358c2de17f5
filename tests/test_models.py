import struct

import pytest
from pyspark.sql import functions as F

from quillstone.operators import models
from quillstone.sources import readers


def test_stacks_and_measurements(spark):
    t = spark.createDataFrame([(f"layers.0.mlp.experts.{e}.w1",) for e in (2, 0, 1)] + [("layers.1.mlp.experts.0.w1",), ("norm",)], "name string")
    got = {(r.layer, r.weight): (r.names[0], r.complete) for r in models.expert_stacks(t, 3).collect()}
    assert got == {(0, "w1"): ("layers.0.mlp.experts.0.w1", True), (1, "w1"): ("layers.1.mlp.experts.0.w1", False)}
    m = spark.createDataFrame([("g", "a", 7.0), ("g", "b", 6.5), ("g", "c", None), ("h", "d", None)], "g string, n string, v double")
    assert [tuple(r) for r in models.best_measurement(m, ["g"], "n", "v").collect()] == [("g", "b", 0.5, 2)]


def test_files_and_changes(spark):
    f = spark.createDataFrame([("X-IQ1_S.gguf", "2025-01-01"), ("X-Q4.gguf", "2025-01-01"), ("Y-iq1_m", "2025-06-01")], "name string, m string").withColumn("modified", F.col("m").cast("timestamp"))
    assert [r.name for r in models.old_files(f, ["iq1_s", "iq1_m"], F.lit("2025-06-15").cast("timestamp"), 30).collect()] == ["X-IQ1_S.gguf"]
    c = spark.createDataFrame([("s", [("convert_x.py", "a\nb\nc"), ("README", "z")]), ("t", [("README", None)])], "sha string, files array<struct<filename string, patch string>>")
    assert [(r.sha, r.files[0].lines) for r in models.relevant_changes(c, "convert|models", 2).collect()] == [("s", ["a", "b"])]
    p = spark.createDataFrame([("/a/b.c.json",), (None,)], "p string")
    assert [r[0] for r in p.select(models.file_stem(F.col("p"), "_x")).collect()] == ["b.c_x", None]


def test_payloads(spark):
    d = spark.createDataFrame([('"plain"',), ('[{"text": "a"}, "b"]',), ('{"content": "c"}',), ("5",), (None,)], "j string").select(F.try_parse_json("j").alias("v"))
    assert [r[0] for r in d.select(models.payload_text(F.col("v"))).collect()] == ["plain", "ab", "c", None, None]
    j = spark.createDataFrame([('{"a": {"num_experts": 3}}',), ('{"a": "experts: no"}',)], "j string")
    assert [r[0] for r in j.select(models.mentions_key(F.col("j"), "experts")).collect()] == [True, False]
    known = j.select(F.sha2(F.lit('{"a": "experts: no"}'), 256).alias("fingerprint"), F.lit("n").alias("name")).limit(1)
    assert {r.j: r.name for r in models.known_fingerprint(j, "j", known).collect()}['{"a": "experts: no"}'] == "n"
    s = spark.createDataFrame([(7.0, 3.0, True), (7.0, None, True), (7.0, 3.0, False)], "p double, a double, m boolean")
    assert [r[0] for r in s.select(models.effective_size(F.col("p"), F.col("a"), F.col("m"))).collect()] == [3.0, 7.0, 7.0]
    assert tuple(models.outcome_counts(s, {"mixtures": F.col("m"), "known": F.col("a").isNotNull()}).first()) == (2, 2)


def gguf():
    text = lambda s: struct.pack("<Q", len(s)) + s.encode()
    head = b"GGUF" + struct.pack("<IQQ", 3, 1, 3)
    pairs = text("name") + struct.pack("<I", 8) + text("m") + text("layers") + struct.pack("<II", 4, 2) + text("tags") + struct.pack("<IIQ", 9, 8, 2) + text("a") + text("b")
    return head + pairs + text("blk.0.attn.weight") + struct.pack("<IQQIQ", 2, 4, 8, 12, 0)


def test_model_files(spark, tmp_path):
    pairs, tensors = readers.parse_gguf(gguf())
    assert pairs == {"name": "m", "layers": 2, "tags": ["a", "b"]} and tensors == [("blk.0.attn.weight", [4, 8], 12)]
    (tmp_path / "m.gguf").write_bytes(gguf())
    assert [(r.name, r.shape, r.kind) for r in readers.gguf_tensors(spark, str(tmp_path / "m.gguf")).collect()] == [("blk.0.attn", [4, 8], 12)]
    for bad in (b"", b"GGUF\x03", gguf()[:-30]):
        with pytest.raises(ValueError):
            readers.parse_gguf(bad)


def test_find_manifest(tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.find_manifest("", str(tmp_path))
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
    (tmp_path / "a" / "stage1_json_manifest.json").write_text("{}")
    assert readers.find_manifest(str(tmp_path)).endswith("a/stage1_json_manifest.json")
    (tmp_path / "b" / "stage1_json_manifest.json").write_text("{}")
    with pytest.raises(ValueError):
        readers.find_manifest(str(tmp_path))
    assert readers.find_manifest(str(tmp_path / "b"), str(tmp_path)).endswith("b/stage1_json_manifest.json")
