import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone import runtime
from quillstone.llm import repeated_lines, scanned

from .records import records


def test_repeated_lines_equal_brute_force(spark, monkeypatch):
    rows = []
    for i in range(60):
        lines = [f"Body text {chr(97 + i % 26) * 3} {chr(97 + i // 26) * 4} stands only here and nowhere else."]
        if i % 3 == 0:
            lines.insert(0, f"  COPY  {i} issued to the reading room, do not distribute this line further please")
        if i % 20 == 0:
            lines.append("Seldom repeated line of text")
        if i % 6 == 0:
            lines.append("short 12")
        rows.append({"output": "\n".join(lines), "source_file": "g" if i % 2 else "f", "chunk_id": f"c{i}"})
    rows += [dict(rows[0]), {"output": None}, {"output": ""}, {"output": rows[0]["output"], "source_file": "f", "chunk_id": None}]
    got = {(r.row_no, r.line_no) for r in repeated_lines.repeated_lines(records(spark, rows)).collect()}
    docs, where = defaultdict(set), defaultdict(set)
    full = [{"source_file": "f.json", "chunk_id": f"d:{i}"} | r for i, r in enumerate(rows, 1)]
    for r in full:
        if r["chunk_id"]:
            docs[r["source_file"]].add(r["chunk_id"])
        for line in (r["output"] or "").split("\n"):
            k = re.sub(r"\s+", " ", re.sub("[0-9]+", "0", line.lower())).strip()
            if sum(map(str.isalpha, k)) >= 12 and r["chunk_id"]:
                where[r["source_file"], k].add(r["chunk_id"])
    want = set()
    for i, r in enumerate(full, 1):
        for n, line in enumerate((r["output"] or "").split("\n"), 1):
            k = re.sub(r"\s+", " ", re.sub("[0-9]+", "0", line.lower())).strip()
            m = len(where.get((r["source_file"], k), ()))
            if m >= 5 and m >= 0.08 * len(docs[r["source_file"]]):
                want.add((i, n))
    assert got == want and want
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", -1)  # sides are joined salted instead of broadcast
    assert {(r.row_no, r.line_no) for r in repeated_lines.repeated_lines(records(spark, rows)).collect()} == want
    left = {r.row_no: r.output for r in repeated_lines.without_repeated_lines(records(spark, rows)).collect()}
    assert "COPY" not in left[1] and left[2] == rows[1]["output"] and left[62] is None
    assert repeated_lines.repeated_lines(records(spark, rows).where("false")).count() == 0


def _pieces(lines):
    raw = [x.encode() for x in lines]
    ends = np.cumsum([len(x) + 1 for x in raw]) - 1
    at = [i for i, x in enumerate(raw) if len(x) >= 12]
    values, offsets = repeated_lines.Stream(b"\n".join([*raw, b""])).chunks(np.array([ends[i] - len(raw[i]) for i in at], np.int64), np.array([ends[i] for i in at], np.int64))
    return {i: values[offsets[k] : offsets[k + 1]].tolist() for k, i in enumerate(at)}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abcdefgh ", min_size=12, max_size=320), max_size=8), st.text("abc ", max_size=60))
def test_chunks_of_a_line_do_not_depend_on_its_neighbours(lines, other):
    alone = {i: _pieces([x])[0] for i, x in enumerate(lines)}
    assert all(alone.values())
    assert _pieces(lines) == alone
    assert _pieces([other, *lines, other]) == {i + 1: x for i, x in alone.items()} | {i: x for i in (0, len(lines) + 1) if len(other) >= 12 for x in [_pieces([other])[0]]}


def test_coarse_chunks_lie_inside_long_lines_only():
    line = "the operator shall not copy this notice, nor any part of it, without the written consent of the reading room; " * 3
    assert len(_pieces([line])[0]) > 5 and len(_pieces(["do not copy!"])[0]) == 1


def test_misreadings():
    assert scanned.misreadings("memory", "rnem0ry") == 2
    assert scanned.misreadings("memory", "memori") is None


def page(text, titles=("Deep Shard Keeping",), first=10, last=12):
    return scanned.Page(text, frozenset(map(scanned.skeleton, titles)), first, last, {"keyboard": 9, "role": 9, "playing": 9})


def test_page_furniture():
    assert page("some text that is\n- 1l -\ngoes on here.").kinds == {"page_number"}
    assert page("text\nPage 11 of 250\ntext").kinds == {"page_number"}
    assert page("text\n13\ntext").kinds == set()
    assert page("12\n4907\n8120").kinds == set()
    assert page("text\nDEEP SHARD KEEPING | 11\ntext").kinds == {"header"}
    assert page("text\n11   2. Call graphs / file permissions\ntext").kinds == {"header"}
    assert page("text", first=None, last=None).kinds == set()


def test_word_breaks():
    p = page("the key-\n\n- 11 -\nboard was there.")
    assert p.kinds == {"hyphenation", "page_number"} and p.lines == ["the keyboard was there."]
    assert page("a role-\nplaying game.").kinds == set()
    assert page("the key¬\nboard.").lines == ["the keyboard."]


def test_reflow():
    lines = ["A line that goes", "on here.", "", "1. First point", "2. Second point", "blk.1.attn=Q4 (12)", "blk.2.attn=Q4 (12)"]
    assert scanned.reflowed(lines) == "A line that goes on here.\n\n1. First point\n2. Second point\nblk.1.attn=Q4 (12)\nblk.2.attn=Q4 (12)"


@pytest.mark.parametrize("rows", [200_000, -1])
def test_page_faults_of_few_rows(spark, monkeypatch, rows):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", rows)  # nothing is broadcast below 0
    text = "The session tokens compare with memory pages before the nightly job."
    rows = [{"output": text, "input": text, "page_start": 1, "page_end": 1}] * 30 + [{"output": "The sessiori tokens compare with memory pages.", "page_start": 1, "page_end": 1}, {"output": "The t0kens compare with rnemory pages before the job.", "page_start": 1, "page_end": 1}]
    assert {(r.row_no, r.kind) for r in scanned.page_faults(records(spark, rows)).collect()} == {(31, "ocr"), (32, "ocr")}
    assert {r.row_no: r.text for r in scanned.repaired_pages(records(spark, rows)).collect()} == {31: "The session tokens compare with memory pages.", 32: "The tokens compare with memory pages before the job."}


def test_page_faults(spark):
    text = "The session tokens compare with memory pages before the nightly job. Default passwords follow network cards."
    rows = [{"output": text, "page_start": 1, "page_end": 2, "input": text}] * 30 + [
        {"output": "The sessiori t0kens compare with memory pages.", "page_start": 1, "page_end": 2}, {"output": None}, {"output": ""},
        {"output": "The word list holds p4ssw0rd9 and 0f2c75a7.", "page_start": None, "page_end": None, "source_title": None},
    ]
    got = {(r.row_no, r.kind) for r in scanned.page_faults(records(spark, rows)).collect()}
    assert got == {(31, "ocr")}
    repaired = {r.row_no: (r.kinds, r.text) for r in scanned.repaired_pages(records(spark, rows)).collect()}
    assert repaired == {31: (["ocr"], "The session tokens compare with memory pages.")}
    assert scanned.page_faults(records(spark, rows).where("false")).count() == 0


def test_copies_and_uncommon_words(spark):
    text = "The session tokens compare with memory pages before the nightly job."
    rows = [{"output": f"{text} {i}.", "page_start": 900, "page_end": 901} for i in range(30)]
    rows += [{"output": "The sessiori tokens compare with memory pages.", "page_start": 900, "page_end": 901}] * 15
    assert {(r.row_no, r.kind) for r in scanned.page_faults(records(spark, rows)).collect()} == {(i, "ocr") for i in range(31, 46)}
    assert {r.text for r in scanned.repaired_pages(records(spark, rows)).collect()} == {"The session tokens compare with memory pages."}
    # an uncommon word: 29 printed, 3 misread with a digit; 34 printed, 2 misread otherwise
    known = scanned.Vocabulary({"wrote": 29, "accueil": 34})
    assert known.printed("wr0te", 3) == [(1, "wrote")] and known.printed("uccueil", 2) == [(1, "accueil")]
    assert known.printed("wrofe", 3) == [] and known.printed("wr0te", 6) == []


def test_any_number_of_confusions(spark):
    known = scanned.Vocabulary({"prüfsummen": 900, "und": 900, "the": 900, "memory": 900})
    for read, n, word in (("prüfsumrneri", 2, "prüfsummen"), ("urid", 1, "und"), ("tlie", 1, "the"), ("thc", 1, "the"), ("rnernory", 2, "memory")):
        assert known.printed(read, 1) == [(n, word)] and scanned.wordlike(read)
    assert known.printed("memory", 1) == [] and known.printed("memori", 1) == []


@settings(max_examples=80, deadline=None)
@given(st.sets(st.text("nrimudcl", min_size=1, max_size=6), max_size=40), st.text("nrimudcl", min_size=1, max_size=7))
def test_confusions_found_are_those_that_explain(words, read):
    found = scanned.Vocabulary(dict.fromkeys(words, 1)).explained(read)
    assert sorted(found) == sorted((n, w) for w in words if (n := scanned.misreadings(w, read)) is not None)


def test_both_sides_of_a_confusion_have_one_shape():
    assert all(a.translate(scanned.SHAPES) == b.translate(scanned.SHAPES) for a, b in scanned.CONFUSIONS)
    assert "modern".translate(scanned.SHAPES) == "modem".translate(scanned.SHAPES) != "model".translate(scanned.SHAPES)


def test_a_word_misread_as_another_word(spark):
    """Both words are frequent; where the neighbours are those of the other one, the word is misread, and only there."""
    rows = [{"output": f"The report shows the modern design of networks in part {i}.", "page_start": 900, "page_end": 901} for i in range(60)]
    rows += [{"output": f"The operator bought a modem adapter for networks in part {i}.", "page_start": 900, "page_end": 901} for i in range(60)]
    rows += [{"output": "The report shows the modem design of networks.", "page_start": 900, "page_end": 901}, {"output": "Someone likes some modem very much.", "page_start": 900, "page_end": 901}]
    assert {(r.row_no, r.kind) for r in scanned.page_faults(records(spark, rows)).collect()} == {(121, "ocr")}
    assert [r.text for r in scanned.repaired_pages(records(spark, rows)).collect()] == ["The report shows the modern design of networks."]


def test_every_title_of_a_volume_counts(spark):
    titles = [f"Quiet {w} Shard" for w in ("Amber", "Birch", "Cedar", "Delta", "Ember", "Fjord")]
    rows = [{"output": "Plain text of a page that goes on.", "source_title": t, "page_start": 900, "page_end": 901} for t in titles]
    rows += [{"output": f"some text\n{t.upper()}\nthat goes on.", "source_title": None, "page_start": 900, "page_end": 901} for t in titles]
    assert {(r.row_no, r.kind) for r in scanned.page_faults(records(spark, rows)).collect()} == {(i, "header") for i in range(7, 13)}
