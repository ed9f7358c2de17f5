import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import packing, splitting

from .records import records

TEXT = "\n\n".join(" ".join(f"Sentence number {i} of paragraph {p} says that things {i * p % 7} happen." for i in range(12)) for p in range(9))
STATUS = "status_id bigint, source_file string, updated_at string, token_cap int, oversized_before int"
PROFILES = [("resplit", 400, 0, 10), ("p", 60, 10, 0)]


@settings(max_examples=60, deadline=None)
@given(st.text("ab .\n!,", max_size=400), st.integers(1, 40), st.integers(0, 20))
def test_parts_join_to_the_text_and_keep_the_cap(text, cap, overlap):
    parts = splitting.split_text(text, cap, overlap)
    assert "".join(text[core:end] for _, core, end, _ in parts) == text
    assert all(n <= cap for *_, n in parts)
    assert all(start <= core for start, core, *_ in parts)


def test_cuts_stand_at_pauses_with_the_overlap():
    parts = splitting.split_text(TEXT, 120, 10)
    for (_, _, end, _), (start, core, _, _) in zip(parts, parts[1:], strict=False):
        assert TEXT[:core].rstrip()[-1] in ".!?"
        assert len(splitting._TOKENS.findall(TEXT[start:core])) == 10
        assert end == core


def test_an_edit_alters_only_neighbouring_parts():
    edited = TEXT.replace("number 5 of paragraph 1", "number five of some paragraph", 1)
    a, b = ({t[c:e] for _, c, e, _ in splitting.split_text(t, 120, 10)} for t in (TEXT, edited))
    assert len(a - b) <= 3 < len(a)


def test_oversized_rows(spark):
    rows = [{"output": "x " * 30}, {"output": "x " * 30, "source_file": "g.json"}, {"output": None}, {"output": ""}, {"output": "x " * 20}, {"output": "a,b" * 11}, {"output": "x " * 30, "source_file": None}]
    status = spark.createDataFrame([(1, "f.json", "2025-01-01", 5, 9), (2, "f.json", "2025-02-01", 20, 9), (3, "g.json", "2025-02-01", None, None), (4, "f.json", None, 1, 1)], STATUS)
    profiles = spark.createDataFrame(PROFILES, "profile string, capacity_tokens int, reserved_tokens int, overlap_tokens int")
    parts = splitting.with_file_counts(splitting.split_oversized(records(spark, rows), status, profiles)).collect()
    assert {r.row_no for r in parts} == {1, 6}
    assert {r.oversized_before for r in parts} == {2}
    assert all(r.part_tokens <= 20 and r.chunk_start == 1 for r in parts)
    assert splitting.split_oversized(records(spark, rows).where("false"), status, profiles).count() == 0
    report = {r.source_file: r.oversized_before for r in splitting.file_report(records(spark, rows), status).collect()}
    assert report == {"f.json": 2}


def naive(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [i for i, r in enumerate(bins) if r >= s]
        if fit:
            i = min(fit, key=lambda i: bins[i])
            bins[i] -= s
        else:
            bins.append(capacity - s)
    return sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80), st.integers(30, 60))
def test_same_containers_as_item_by_item(sizes, capacity):
    counts = {s: sizes.count(s) for s in sizes}
    room: dict[int, int] = {}
    for size, _, n, each, first in packing.best_fit_decreasing(list(counts.items()), capacity):
        assert n % each == 0
        for k in range(n):
            b = first + k // each
            room[b] = room.get(b, capacity) - size
    assert sorted(room.values()) == naive(sizes, capacity)


def test_pack(spark):
    rng = random.Random(1)
    rows = [{"output": "w " * rng.randint(0, 130), "doc_id": rng.choice(["a", "b", None]), "semantic_block_index": i} for i in range(200)] + [{"output": None}, {"output": "w " * 7}] * 3
    got = packing.pack(records(spark, rows), 50).collect()
    fill: dict[tuple, int] = {}
    for r in got:
        fill[r.doc_id, r.container] = fill.get((r.doc_id, r.container), 0) + r.size
        assert r.size == r.token_end - r.token_start and (r.piece_count == 1 or r.size == 50 or r.piece_index == r.piece_count)
    assert max(fill.values()) <= 50 and len({(r.row_no, r.piece_index) for r in got}) == len(got)
    for d in ("a", "b", None):
        assert sum(1 for k in fill if k[0] == d) == len(naive([r.size for r in got if r.doc_id == d and r.size], 50))
    assert {r.row_no for r in got} == set(range(1, len(rows) + 1))
    assert packing.pack(records(spark, rows).where("false"), 50).count() == 0
    with pytest.raises(ValueError):
        packing.pack(records(spark, rows), 0)


def test_usable_capacity(spark):
    profiles = spark.createDataFrame(PROFILES, "profile string, capacity_tokens int, reserved_tokens int, overlap_tokens int")
    assert packing.usable_capacity(profiles, "p") == 50
    with pytest.raises(ValueError):
        packing.usable_capacity(profiles, "none")
