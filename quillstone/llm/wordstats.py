"""Corpus counts of words and word pairs, and what they say about how a text ends."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .copies import with_repeats

#: A word or pair of the statistics makes up at least this share of all tokens, so that there are at most 2 / SHARE of them.
SHARE = 4e-6
LEAST_COUNT = 3
#: A stump is that many times rarer than the longer word.
_STUMP = 30

_TOKENS = re.compile(r"[^\W_]+(?:[’'-][^\W_]+)*|[.!?]|\n").findall
_THINK = re.compile(r"<think>.*?(?:</think>|$)", re.S | re.I)
_INVISIBLE = re.compile("[\\s​-‏⁠﻿­᠎]+")
#: What stands for a missing value.
STAND_INS = frozenset(("n/a", "na", "n.a.", "n. a.", "null", "none", "nil", "nan", "-", "--", "---", "–", "—", "...", "…", "?", "??", "tbd", "todo", "unknown", "undefined", "missing", "empty", "no answer", "[no answer]", "(no answer)", "[empty]", "not available", "keine angabe", "k. a.", "k.a.", "sin respuesta", "sans réponse", "s.o.", "s/o", "n/d", "keine antwort", "pas de réponse", "no data", "#n/a"))
_MARK = re.compile(r"\s*(?:[\[(<{]\s*(?:\.{2,}|…|truncated|cut(?: off)?|more|continued|snip|gekürzt|abgeschnitten|tronqué|coupé|truncado|cortado|suite|fortsetzung|\+\d+ chars?)\s*[\])>}]|\.{3,}|…|(?:\.\s){2}\.|(?:read|see) more|>>|→|-->)\s*$", re.I)
#: Characters with which a mark of omission can end.
_MARK_ENDS = frozenset(".…])>}→Ee")
_QUOTES = "\"'“”„«»‘’‚‹›"
_SENTENCE = re.compile(r"(?<=[^\W\d_]{2}[.!?])[”\"»’]*\s+(?=[“\"«„‘¿¡]?[^\W\d_])|(?<=[^\W\d_] [.!?])[”\"»’]*\s+(?=[^\W\d_])|(?<=[)”»][.!?])\s+(?=[^\W\d_])")
_BEFORE, _AFTER = " \t\n¿¡" + _QUOTES, " )\n\t" + _QUOTES


def visible(text: str | None) -> str:
    """The text without reasoning in think tags and without invisible characters around it; ``""`` for null."""
    if not text:
        return ""
    if "<think>" in text.lower():
        text = _THINK.sub(" ", text)
    return text.strip().strip("​‌‍⁠﻿­ \t\n\r ")


def is_empty(text: str | None, seen: str | None = None) -> bool:
    """Null, blank, invisible, a stand-in for a missing value, or only reasoning. ``seen``: the visible text, if known."""
    if seen is None:
        seen = visible(text)
    if len(seen) > 60 and not seen[0].isspace():
        return False
    return not _INVISIBLE.sub("", seen) or seen.lower().strip(" .") in STAND_INS or seen.lower() in STAND_INS


_ASCII_MARKS = b"\"#$%&()*+,/:;<=>@[\\]^_`{|}~\n\t\r\f\v"
_WIDE_MARKS = tuple(c.encode() for c in "“”„«»‹›‚…—–¿¡•·©®→\xa0\u202f")
_BLANK = bytes.maketrans(_ASCII_MARKS, b" " * len(_ASCII_MARKS))
_BLANK_ALL = bytes.maketrans(_ASCII_MARKS + b".!?-", b" " * (len(_ASCII_MARKS) + 4))
_ONE_END = bytes.maketrans(_ASCII_MARKS + b"!?", b" " * len(_ASCII_MARKS) + b"..")


def unmarked(text: str, table: bytes) -> bytes:
    """The text in lower case as UTF-8, its punctuation blank as ``table`` says; bytes take a fraction of a string's time."""
    raw = text.lower().encode().translate(table)
    if b"\xe2" in raw or b"\xc2" in raw:
        for mark in _WIDE_MARKS:
            if mark in raw:
                raw = raw.replace(mark, b" ")
    return raw


def plain_words(text: str) -> list[bytes]:
    """Runs without white space and punctuation, in lower case."""
    return unmarked(text, _BLANK_ALL).split()


def count_words(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``key, n`` over the distinct texts of each of ``columns`` (column -> group; the empty group: single words only).

    A value counts once per column, in the row of the lowest ``row_no``, so that
    copies of a cut one do not make its stump or its first word frequent.

    Keys: ``w`` a word in lower case; ``w x`` a pair; ``w .`` a word before a
    sentence end; ``^g w`` and ``^g w .``: a value of group g that begins with
    w, and one that also ends with a sentence end; ``^g w ?``: with a question
    mark. Counted per task before the
    shuffle.
    """
    groups = list(columns.values())
    texts = df.select("row_no", *(F.col(k).cast("string").alias(f"t{c}") for c, k in enumerate(columns)))
    src = with_repeats(texts, "row_no", [f"t{c}" for c in range(len(groups))]).drop("row_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: Counter = Counter()
        singles: Counter = Counter()
        finals: Counter = Counter()
        firsts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out: Counter = Counter()
            for w, n in singles.items():
                out[w.decode()] += n
            for w, n in finals.items():
                out[f"{w.decode()} ."] += n
            for (a, b), n in pairs.items():
                if a not in (b"|", b"."):
                    out[a.decode()] += n
                    if b != b"|":
                        out[f"{a.decode()} {b.decode()}"] += n
            out.update(firsts)
            for c in (pairs, singles, finals, firsts):
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], names=["key", "n"])

        for b in batches:
            repeats = b.column(len(groups)).to_pylist()
            for c, g in enumerate(groups):
                texts = [t for t, again in zip(b.column(c).to_pylist(), repeats, strict=True) if t and not (again and c in again)]
                if not g:
                    for t in texts:
                        parts = unmarked(t, _ONE_END).split(b".")
                        singles.update(b" ".join(parts).split())
                        finals.update([x.rpartition(b" ")[2] for x in parts[:-1] if x and x[-1] != 32])
                    continue
                tokens = b" | ".join([unmarked(t, _ONE_END) for t in texts]).replace(b".", b" . ").split()
                if tokens:
                    pairs.update(zip(tokens, tokens[1:] + [b"|"], strict=True))
                for t in texts:
                    if first := t[:120].lstrip(_BEFORE).split(None, 1):
                        firsts[f"^{g} {first[0].lower()}"] += 1
                        end = t[-12:].rstrip(_AFTER)[-1:]
                        if end in (".", "!", "?"):
                            firsts[f"^{g} {first[0].lower()} ."] += 1
                        if end == "?":
                            firsts[f"^{g} {first[0].lower()} ?"] += 1
            if len(pairs) + len(singles) > 600_000:
                yield flush()
        yield flush()

    return src.mapInArrow(run, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame) -> dict[str, int]:
    """The counts of at least ``SHARE`` of all words (bounded in number by that), for broadcasting."""
    total = counts.where(~F.col("key").contains(" ")).agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_COUNT, int(total * SHARE))
    return {r.key: r.n for r in counts.where((F.col("n") >= least) | (F.col("key").startswith("^") & (F.col("n") >= LEAST_COUNT) & (F.col("n") >= least / 50))).toLocalIterator()}


@dataclass
class Ending:
    """How a value ends. ``kind``: empty, terminal (a sentence end), marked (a mark of omission), open (neither)."""

    kind: str
    body: str
    score: float
    stump: float = 0.0


class EndingModel:
    """Log odds that a value ends before its sentence does, from corpus counts."""

    def __init__(self, counts: dict[str, int]):
        self.n = counts
        self.sorted = sorted(k for k in counts if k[0] != "^")
        self.longer: dict[str, int] = {}

    def _continues(self, stem: str) -> int:
        """Count of the most frequent longer word (or pair) that begins with ``stem``; 0 without one."""
        if (known := self.longer.get(stem)) is not None:
            return known
        i, best = bisect_left(self.sorted, stem), 0
        while i < len(self.sorted) and self.sorted[i].startswith(stem):
            k = self.sorted[i]
            if len(k) > len(stem) and k[len(stem)] == " ":  # the pairs of the stem itself are skipped at once
                i = bisect_left(self.sorted, stem + "!", i)
                continue
            if len(k) > len(stem):
                best = max(best, self.n[k])
            i += 1
        if len(self.longer) > 200_000:
            self.longer.clear()
        self.longer[stem] = best
        return best

    def last_words(self, body: str) -> list[str]:
        return [w for w in _TOKENS(body[-80:].lower()) if w not in ".!?\n"][-2:]

    def broken_word(self, ws: list[str]) -> float:
        """Log odds that the last of the words that end a text is a stump."""
        if not ws:
            return 0.0
        last, prev = ws[-1], ws[-2] if len(ws) > 1 else None
        if not last.isalpha() and not any(map(str.isalpha, last)):
            return 0.0
        known = self.n.get(last, 0)
        if prev and self._continues(f"{prev} {last}") > _STUMP * self.n.get(f"{prev} {last}", 0):
            return 8.0 if self.n.get(last + " .", 0) <= 0.05 * known or self._continues(last) > _STUMP * known else 2.0
        if self._continues(last) > _STUMP * known:
            return 6.0
        return 1.5 if not known else 0.0

    def unfinished(self, ws: list[str]) -> float:
        """Log odds from how seldom the last word stands before a sentence end."""
        if not ws:
            return 0.0
        known, final = self.n.get(ws[-1], 0), self.n.get(ws[-1] + " .", 0)
        if known < 20:
            return 0.0
        share = (final + 0.5) / (known + 10)
        return 6.0 if share < 0.0005 else 4.0 if share < 0.002 else 0.0 if share < 0.03 else -1.0

    def judge(self, text: str | None, group: str, seen: str | None = None) -> Ending:
        """``seen``: the visible text, if known."""
        if seen is None:
            seen = visible(text)
        if is_empty(text, seen):
            return Ending("empty", "", -20.0)
        body, marked = seen, False
        while (tail := body.rstrip(_QUOTES + " ")[-60:]) and (tail[-1] != "." or tail[-2:-1] in (".", " ")) and tail[-1] in _MARK_ENDS and (m := _MARK.search(tail)):
            body, marked = body.rstrip(_QUOTES + " ")[: m.start() - len(tail)], True
            if not body.strip():
                return Ending("empty", "", -20.0)
        core = body.rstrip(_QUOTES + " )\n\t")
        ends = core[-1:] in ("." , "!", "?", "。", "！", "？")
        if marked:
            stump = self.broken_word(self.last_words(core))
            return Ending("marked", body, -4.0 if ends and stump < 5 else 7.0, stump)
        ws = self.last_words(core)
        stump = self.broken_word(ws)
        if ends:
            whole = -5.0 + stump
            if core[-1] == ".":
                # a full stop where values that begin so end in a question mark was put there later
                first = seen.lstrip(_BEFORE).split(None, 1)[:1]
                n, asks = (self.n.get(f"^{group} {first[0].lower()}{x}", 0) for x in ("", " ?")) if first else (0, 0)
                whole += 6.0 if n >= 20 and asks > 0.7 * n else self.unfinished(ws)
            return Ending("terminal", body, whole, stump)
        # the value's first word and that of what follows its last sentence end: labels and keyword lists begin with words that sentences don't
        parts = [seen, *_SENTENCE.split(core)[1:][-1:]]
        score = stump + (5.0 if len(parts) > 1 else 0.0)
        for part in parts:
            first = part.lstrip(_QUOTES + "¿¡ \n\t").split(None, 1)
            first = first[0].lower() if first else ""
            n, t = self.n.get(f"^{group} {first}", 0), self.n.get(f"^{group} {first} .", 0)
            share = (t + 0.6) / (n + 2)
            odds = -1.0 if n < 3 else 4.0 if share > 0.4 else 1.0 if share > 0.2 else -3.5
            if part is parts[-1]:
                score += odds if len(parts) == 1 else -8.5 if n >= 3 and share < 0.1 else 0.0
        if core[-1:] in (",", ";", ":", "(", "-", "–", "—", "“", "«", "„"):
            score += 3.0
        return Ending("open", body, score + 1.0, stump)
