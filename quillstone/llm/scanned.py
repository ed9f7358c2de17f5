"""Problem 7: faults of scanned pages (hyphenation, misread words, running headers, page numbers) and their repair."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.runtime import cut, measured, salted_join

from .copies import with_copies
from .filters import bloom_bits, passed
from .wordstats import plain_words

#: What scanners make of letters (as printed, as read).
CONFUSIONS = (
    ("e", "c"), ("s", "5"), ("t", "f"), ("a", "u"), ("i", "l"), ("n", "ri"), ("l", "1"), ("i", "1"), ("o", "0"), ("u", "ii"), ("h", "li"), ("m", "rn"),
    ("g", "9"), ("é", "6"), ("b", "6"), ("w", "vv"), ("rn", "m"), ("ri", "n"), ("d", "cl"), ("cl", "d"), ("b", "8"), ("z", "2"), ("q", "9"), ("c", "e"), ("ó", "6"),
    ("ü", "ii"), ("m", "rri"), ("n", "rl"), ("u", "ll"), ("a", "ii"), ("h", "ll"),
)
#: A word counts as printed if at least so many rows have it.
LEAST_COUNT = 5
#: A misread form is this many times rarer than the word it stands for; it counts once per distinct text, the word in every row.
RARER = 20
#: The same for a form with a digit among its letters, and for one that at most FEW distinct texts have.
RARER_DIGIT = 5
RARER_FEW = 10
FEW = 2
#: Words of at least so many letters may be misread as another word of the vocabulary.
CONTESTED_LENGTH = 4
#: Confusions by the first letter read.
_READ_BY = {c: tuple((a, b) for a, b in CONFUSIONS if b[0] == c) for c in {b[0] for _, b in CONFUSIONS}}



def _shapes() -> dict[str, str]:
    """What each letter is written as so that both sides of every confusion are written alike."""
    base: dict[str, str] = {}

    def find(c: str) -> str:
        while c in base:
            c = base[c]
        return c

    for a, b in CONFUSIONS:
        if len(a) == len(b) == 1 and find(a) != find(b):
            base[find(b)] = find(a)
    parts = {find(x): y for a, b in CONFUSIONS for x, y in ((a, b), (b, a)) if len(x) == 1 and len(y) > 1}

    def full(c: str) -> str:
        return "".join(map(full, parts[find(c)])) if find(c) in parts else find(c)

    return {c: full(c) for pair in CONFUSIONS for c in "".join(pair)}


#: Words that any number of confusions turn into each other have one shape.
SHAPES = str.maketrans(_shapes())

_HEX = re.compile(r"[0-9a-f]{2}|(?=[a-f]*[0-9])(?:[0-9a-f]{8}|[0-9a-f]{16,})")
_NUMBER = re.compile(r"(?P<open>\W*?)(?:(?P<name>page|seite|página|pagina|pág|folio|p|s)\b\.?\s*)?(?P<n>[0-9lIiOoSsBgZz|]{1,6})(?:\s*(?:of|von|de|sur|/)\s*[0-9lIO]{1,6})?(?P<close>\W*)", re.I)
_DIGITS = str.maketrans("lIi|OoSsBgZz", "111100558922")
_NUMBERED = re.compile(r"^(?:(?P<a>[0-9lIO]{1,5})\s{1,6}(?=\D|\d{1,3}\. ))?(?P<t>\S.*?)(?:\s*\|\s*(?P<b>[0-9lIO]{1,5})|\s{2,}(?P<c>[0-9lIO]{1,5}))?$")
_CHAPTER = re.compile(r"\d{1,3}\.\s+[^.!?:;/]{2,60}\s/\s[^.!?:;/]{2,60}")
_BREAK = re.compile(r"([^\W\d_]+)([-‐‑¬\xad])[ \t]*$")
_NEXT = re.compile(r"\s*([^\W\d_]+)")
_SKELETON = [("vv", "w"), ("rn", "m"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("cl", "d")]
_SAME = str.maketrans("051i9c6fa8é", "osllgeetube")


_NO_LETTERS = {c: None for c in map(ord, " \t\r\f\v\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~!“”„«»‹›‘’‚…—–¿¡•·©®→\xa0\u202f")}


def skeleton(title: str) -> str:
    """A title's letters, as far as they stay apart when misread."""
    s = title.lower().translate(_NO_LETTERS)
    for a, b in _SKELETON:
        s = s.replace(a, b)
    return s.translate(_SAME)


def page_number(line: str, first: int | None, last: int | None) -> bool:
    """Whether the line is only a printed page number of the pages ``first``..``last``, maybe with a digit misread."""
    s = line.strip()
    if not s or len(s) > 40 or first is None or last is None:
        return False
    m = _NUMBER.fullmatch(s)
    if not m:
        return False
    raw = m["n"]
    dressed = bool(m["name"] or m["open"].strip() or m["close"].strip())
    if not any(c.isdigit() for c in raw) and not dressed:
        return False
    digits = raw.translate(_DIGITS)
    if not digits.isdigit():
        return False
    return first <= int(digits) <= last


def is_header(line: str, titles: frozenset[str]) -> bool:
    """Whether the line is the running book or chapter title, with or without a page number. ``titles``: skeletons."""
    s = line.strip()
    if len(s) < 4 or len(s) > 130 or s[-1] in ".!?;:,":
        return False
    if skeleton(s) in titles:
        return True
    m = _NUMBERED.match(s) if " / " in s or s[0] in "0123456789lIO" or s[-1] in "0123456789lIO" else None
    return bool(m) and (skeleton(m["t"]) in titles or bool(_CHAPTER.fullmatch(m["t"])))


class Page:
    """One text: its faults other than misread words, and its lines without page furniture and word breaks."""

    def __init__(self, text: str, titles: frozenset[str], first: int | None, last: int | None, vocabulary: Container[str] | None = None):
        self.kinds: set[str] = set()
        kept: list[str] = []
        lines = text.split("\n")
        bare = [len(ln) < 40 and ln.strip().isdigit() for ln in lines]
        pending_blank = False
        gone = False
        for i, line in enumerate(lines):
            # a bare number next to one that is no page number belongs to a block of numbers
            block = bare[i] and any(0 <= j < len(lines) and bare[j] and not page_number(lines[j], first, last) for j in (i - 1, i + 1))
            if not block and page_number(line, first, last):
                self.kinds.add("page_number")
                gone = True
            elif is_header(line, titles):
                self.kinds.add("header")
                gone = True
            elif not line.strip():
                pending_blank = True
            else:
                # blank lines around furniture are the page's, not the text's
                if pending_blank and kept and not (gone and not _ended(kept[-1])):
                    kept.append("")
                pending_blank = gone = False
                kept.append(line)
        self.lines = kept
        self._join(vocabulary)

    def _join(self, vocabulary: Container[str] | None) -> None:
        lines = self.lines
        if not any(x.rstrip()[-1:] in tuple("-‐‑¬\xad") for x in lines):
            return
        out: list[str] = []
        at = 0
        while at < len(lines):
            line = lines[at]
            m = _BREAK.search(line)
            after = at + 1
            while m and after < len(lines) and not lines[after].strip():
                after += 1
            nxt = _NEXT.match(lines[after]) if m and after < len(lines) else None
            if m and vocabulary and not (nxt and nxt[1][:1].islower()):
                # a notice may stand between the halves: the next lines are tried for one that makes a known word
                for far in range(after + 1, min(len(lines), after + 5)):
                    x = _NEXT.match(lines[far])
                    if x and (m[1] + x[1]).lower() in vocabulary:
                        lines[far] = line[: m.start(2)] + lines[far].lstrip()
                        self.kinds.add("hyphenation")
                        line, m, nxt = None, None, None
                        break
            if line is None:
                at += 1
                continue
            if nxt and nxt[1][:1].islower():
                a, b = m[1], nxt[1]
                joined = (a + b).lower()
                compound = m[2] in "-‐‑" and vocabulary is not None and joined not in vocabulary and a.lower() in vocabulary and b.lower() in vocabulary
                if not compound:
                    self.kinds.add("hyphenation")
                lines[after] = line[: m.start(2)] + ("-" if compound else "") + lines[after].lstrip()
            else:
                out.append(line)
                if m and after == len(lines) and m[2] in "¬\xad":
                    self.kinds.add("hyphenation")
            at = after if nxt and nxt[1][:1].islower() else at + 1
        self.lines = out

    def words(self) -> list[bytes]:
        """Words of the text in lower case, as UTF-8; a last word that no sentence end follows may be cut and is left out."""
        return _words("\n".join(self.lines))


def _words(text: str) -> list[bytes]:
    text = text.rstrip()
    ws = plain_words(text)
    if ws and text[-1:].isalnum():
        ws.pop()
    return ws


def _ended(line: str) -> bool:
    return line.rstrip()[-1:] in tuple(".!?:;…”\"»“)")


def wordlike(word: str) -> bool:
    """Whether a word that is not in the vocabulary may be a misread one: letters, few digits, no code."""
    digits = sum(map(str.isdigit, word))
    return len(word) >= 3 and digits * 3 < len(word) and not _HEX.fullmatch(word)


def rarer(word: str, count: int) -> int:
    """How many times as frequent the printed word of a misread one is at least."""
    if any(map(str.isdigit, word)):
        return RARER_DIGIT
    return RARER_FEW if count <= FEW else RARER


class Vocabulary:
    """Words in a trie, against which automata of a read word are intersected."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.root: dict = {}
        for w in counts:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def explained(self, word: str) -> list[tuple[int, str]]:
        """``(readings, word)`` of every word that confusions turn into ``word``, whatever their number.

        The trie is intersected with a Levenshtein automaton of ``word`` whose
        edits are the confusions, of one to three letters each: a state is a
        node, the letters read and the least number of edits so far.
        """
        best: dict[str, int] = {}
        seen: dict[tuple[int, int], int] = {}
        stack = [(self.root, 0, 0)]
        while stack:
            node, at, n = stack.pop()
            if seen.get((id(node), at), n + 1) <= n:
                continue
            seen[id(node), at] = n
            if at == len(word):
                if (v := node.get("")) is not None:
                    best[v] = min(n, best.get(v, n))
                continue
            if (child := node.get(word[at])) is not None:
                stack.append((child, at + 1, n))
            for a, b in _READ_BY.get(word[at], ()):
                if word.startswith(b, at):
                    child = node
                    for c in a:
                        if (child := child.get(c)) is None:
                            break
                    else:
                        stack.append((child, at + len(b), n + 1))
        return [(n, v) for v, n in best.items()]

    def printed(self, word: str, count: int) -> list[tuple[int, str]]:
        """``(readings, word)`` of the vocabulary words that a scanner can have misread as ``word``, the best first."""
        least = rarer(word, count) * count
        found = [(n, v) for n, v in self.explained(word) if n and self.counts[v] >= least]
        # a candidate that is itself a misread form of another one is none
        found = [(n, v) for n, v in found if not any(self.counts[w] >= RARER * self.counts[v] and misreadings(w, v) is not None for _, w in found)]
        return sorted(found, key=lambda f: (f[0], -self.counts[f[1]], f[1]))

    def rivals(self, word: str) -> list[str]:
        """Words about as frequent as a vocabulary word, of which it may be a misreading; the most frequent first."""
        own = self.counts.get(word, 0)
        found = [v for n, v in self.explained(word) if n and v.isalpha() and own and self.counts[v] * RARER > own]
        return sorted(found, key=lambda v: (-self.counts[v], v))


def confused(printed: str, read: str) -> list[tuple[str, str]] | None:
    """The fewest confusions that turn ``printed`` into ``read``; None if confusions alone cannot."""
    n, m = len(printed), len(read)
    best: list[list[list | None]] = [[None] * (m + 1) for _ in range(n + 1)]
    best[0][0] = []
    for i in range(n + 1):
        for j in range(m + 1):
            here = best[i][j]
            if here is None:
                continue
            if i < n and j < m and printed[i] == read[j] and (best[i + 1][j + 1] is None or len(best[i + 1][j + 1]) > len(here)):
                best[i + 1][j + 1] = here
            for a, b in CONFUSIONS:
                if printed.startswith(a, i) and read.startswith(b, j):
                    x, y = i + len(a), j + len(b)
                    if best[x][y] is None or len(best[x][y]) > len(here) + 1:
                        best[x][y] = [*here, (a, b)]
    return best[n][m]


def misreadings(printed: str, read: str) -> int | None:
    """Least number of confusions that turn ``printed`` into ``read``; None if confusions alone cannot."""
    steps = confused(printed, read)
    return None if steps is None else len(steps)


def _with_titles(records: DataFrame) -> DataFrame:
    """``row_no, output, page_start, page_end, titles``; a null or blank title is looked up in the volume's other rows.

    Only rows without a title are joined, to the different titles of their volume.
    """
    base = records.where("output is not null").select("row_no", F.col("output").cast("string").alias("output"), "page_start", "page_end", "doc_id", F.nullif(F.trim("source_title"), F.lit("")).alias("title"))
    own = base.where("title is not null").select("row_no", "output", "page_start", "page_end", F.array("title").alias("titles"))
    per_volume = records.where("trim(source_title) <> '' and doc_id is not null").groupBy("doc_id").agg(F.collect_set(F.lower(F.trim("source_title"))).alias("titles"))
    other = salted_join(base.where("title is null"), per_volume, ["doc_id"], "left").select("row_no", "output", "page_start", "page_end", F.coalesce("titles", F.array().cast("array<string>")).alias("titles"))
    return own.unionByName(other)


def _pages(b: pa.RecordBatch, vocabulary: Container[str] | None) -> Iterator[tuple[int, Page]]:
    for row, text, first, last, titles in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
        yield row, Page(text, frozenset(s for t in titles if len(s := skeleton(t)) >= 4), first, last, vocabulary)


def word_counts(records: DataFrame, texts: DataFrame) -> DataFrame:
    """``word, n, n_rows``: all words in lower case of the repaired lines of ``texts`` and of the records' questions; summed up per task before the shuffle.

    ``n`` counts every different text once, ``n_rows`` every row. Rows with
    ``n_rows`` null name words that stand at line breaks.
    """

    def flush(counts: Counter, again: Counter) -> pa.RecordBatch:
        words = list(counts.keys() | again.keys())
        n = [counts[w] for w in words]
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()), pa.array(n, pa.int64()), pa.array([k + again[w] for w, k in zip(words, n, strict=True)], pa.int64())], names=["word", "n", "n_rows"])

    def of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        again: Counter = Counter()
        asked: set[str] = set()
        for b in batches:
            for copy, (_, page) in zip(b.column(5).to_pylist(), _pages(b, _Asked(asked)), strict=True):
                (again if copy else counts).update(page.words())
            if len(counts) + len(again) + len(asked) > 600_000:
                yield flush(counts, again)
                yield pa.RecordBatch.from_arrays([pa.array(list(asked), pa.string()), pa.nulls(len(asked), pa.int64()), pa.nulls(len(asked), pa.int64())], names=["word", "n", "n_rows"])
                counts.clear()
                again.clear()
                asked.clear()
        yield flush(counts, again)
        yield pa.RecordBatch.from_arrays([pa.array(list(asked), pa.string()), pa.nulls(len(asked), pa.int64()), pa.nulls(len(asked), pa.int64())], names=["word", "n", "n_rows"])

    def of_fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        again: Counter = Counter()
        for b in batches:
            for at, total in ((1, counts), (2, again)):
                total.update(plain_words("\n".join(t for c in (0, 1, 2) for t, copy in zip(b.column(c).to_pylist(), b.column(3).to_pylist(), strict=True) if t and copy == (at == 2))))
            if len(counts) + len(again) > 600_000:
                yield flush(counts, again)
                counts.clear()
                again.clear()
        yield flush(counts, again)

    fields = ("input", "alt_question_1", "alt_question_3")
    asked = records.select("row_no", *(F.col(c).cast("string").alias(c) for c in fields))
    asked = with_copies(asked.withColumn("all", F.concat_ws("\n", *fields)), "row_no", "all").select(*fields, "again")
    schema = "word string, n bigint, n_rows bigint"
    outputs = with_copies(texts, "row_no", "output").select(*texts.columns, "again")
    both = outputs.mapInArrow(of_pages, schema).unionByName(asked.mapInArrow(of_fields, schema))
    return both.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"), F.bool_or(F.col("n_rows").isNull()).alias("asked"))


class _Asked:
    """A vocabulary that knows nothing and writes down what it is asked."""

    def __init__(self, asked: set[str]):
        self.asked = asked

    def __contains__(self, word: str) -> bool:
        self.asked.add(word)
        return False


def misread_forms(words: DataFrame) -> DataFrame:
    """``form, printed, choices, contested``: misread forms and the words they stand for, and words that may be one another's misreadings.

    Words are grouped by shape, of which confusions, however many, leave
    everything as it was; so all candidates for a form are in its group,
    whatever the size of the vocabulary. In a group, automata that read a form
    are walked together with a trie of the printed words. ``contested``: the
    word is itself too frequent for a misreading, so each occurrence is decided
    by its neighbours.
    """
    shaped = words.where((F.length("word") >= 3) & ~F.col("word").rlike("^[0-9]+$") & (F.col("n_rows") > 0))

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([w.translate(SHAPES) for w in b.column(0).to_pylist()], pa.string()), *b.columns], names=["shape", "word", "n", "n_rows"])

    shaped = shaped.select("word", "n", "n_rows").mapInArrow(shape, "shape string, word string, n bigint, n_rows bigint")
    groups = shaped.groupBy("shape").agg(F.collect_list(F.struct("word", "n", "n_rows")).alias("words"), F.max("n_rows").alias("most")).where((F.size("words") > 1) & (F.col("most") >= LEAST_COUNT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for group in b.column(0).to_pylist():
                known = Vocabulary({w["word"]: w["n_rows"] for w in group if w["n_rows"] >= LEAST_COUNT})
                for w in group:
                    word, n = w["word"], w["n"]
                    if not wordlike(word):
                        continue
                    if n and (found := known.printed(word, n)):
                        rows.append((word, found[0][1], [v for k, v in found if k == found[0][0]], False))
                    elif len(word) >= CONTESTED_LENGTH and word.isalpha() and (rivals := known.rivals(word)):
                        rows.append((word, rivals[0], rivals, True))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["form", "printed", "choices", "contested"])

    return groups.select("words").mapInArrow(run, "form string, printed string, choices array<string>, contested boolean")


def _kept(bits: np.ndarray, words: set[bytes]) -> set[bytes]:
    """Words that the filter lets through."""
    names = list(words)
    h = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in names), np.uint64, len(names)).view(np.int64)
    return {names[i] for i in np.flatnonzero(passed(bits, h))}


def _prepared(records: DataFrame):
    """Texts with titles, the known ones of the words at line breaks (broadcast if few, else a column of the texts), and the forms."""
    spark = records.sparkSession
    texts = _with_titles(records)
    words = cut(word_counts(records, texts))
    forms = cut(misread_forms(words))
    at_breaks, fits = measured(words.where(F.col("asked") & (F.col("n_rows") >= LEAST_COUNT)).select("word"))
    if fits:
        known = spark.sparkContext.broadcast(frozenset(r.word for r in at_breaks.toLocalIterator()))
        return texts.withColumn("known", F.lit(None).cast("array<string>")), known, forms, words

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, asked = [], []
            for row, one in zip(b.column(0).to_pylist(), range(b.num_rows), strict=True):
                said: set[str] = set()
                next(_pages(b.slice(one, 1), _Asked(said)))
                rows += [row] * len(said)
                asked += said
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(asked, pa.string())], names=["row_no", "word"])

    per = texts.mapInArrow(ask, "row_no bigint, word string").join(at_breaks, "word").groupBy("row_no").agg(F.collect_set("word").alias("known"))
    return texts.join(per, "row_no", "left"), None, forms, words


def _checked(b: pa.RecordBatch, known) -> Iterator[tuple[int, Page]]:
    """Pages of a batch whose sixth column may hold the known words of each text's breaks."""
    if known is not None:
        yield from _pages(b, known.value)
        return
    for i, words in enumerate(b.column(5).to_pylist()):
        yield next(_pages(b.slice(i, 1), frozenset(words or ())))


def _found(records: DataFrame):
    """The prepared tables, and per text with any fault ``row_no, kinds, hits``: what its lines show, and words the filter lets through with their neighbours."""
    spark = records.sparkSession
    texts, known, forms, words = _prepared(records)
    watched = forms.select("form").union(forms.where("contested or size(choices) > 1").select(F.explode("choices"))).distinct()
    bits = spark.sparkContext.broadcast(bloom_bits(watched, F.xxhash64("form")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = [(row, sorted(page.kinds), page.words()) for row, page in _checked(b, known)]
            kept = _kept(bits.value, set().union(*(ws for _, _, ws in pages)))
            rows, kinds, hits = [], [], []
            for row, kind, ws in pages:
                met = [] if kept.isdisjoint(ws) else [{"form": w.decode(), "prev": (ws[i - 1] if i else b"").decode(), "next": (ws[i + 1] if i + 1 < len(ws) else b"").decode()} for i, w in enumerate(ws) if w in kept]
                if kind or met:
                    rows.append(row)
                    kinds.append(kind)
                    hits.append(met)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kinds, pa.list_(pa.string())), pa.array(hits, pa.list_(pa.struct([(k, pa.string()) for k in ("form", "prev", "next")])))], names=["row_no", "kinds", "hits"])

    found = cut(texts.mapInArrow(run, "row_no bigint, kinds array<string>, hits array<struct<form string, prev string, next string>>"))
    return texts, known, forms, words, found


def _confusion_costs(forms: DataFrame, words: DataFrame, rounds: int = 2) -> dict[tuple[str, str], float]:
    """Log odds against each confusion in a word, by expectation-maximisation over forms and the words they may stand for.

    A form's count is shared among its choices by their frequency and the
    probability of the confusions between them; the confusions' counts are
    summed up again. As many numbers as there are confusions come to the driver.
    """
    total = max(1, words.agg(F.sum("n_rows")).first()[0] or 0)
    single = forms.where("not contested").join(words.select(F.col("word").alias("form"), "n"), "form").select("form", "n", F.explode("choices").alias("printed"))
    pairs = cut(single.join(words.select(F.col("word").alias("printed"), "n_rows"), "printed"))
    costs = {c: math.log(1e4) for c in CONFUSIONS}
    for _ in range(rounds):
        now = dict(costs)

        def expect(batches: Iterator[pa.RecordBatch], now: dict = now) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, path, weight = [], [], []
                for form, printed, n, rows in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                    steps = confused(printed, form) or []
                    at.append(form)
                    path.append([f"{a} {x}" for a, x in steps])
                    weight.append(rows * math.exp(-sum(now[s] for s in steps)))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.string()), b.column(2), pa.array(path, pa.list_(pa.string())), pa.array(weight, pa.float64())], names=["form", "n", "path", "weight"])

        each = pairs.select("form", "printed", "n", "n_rows").mapInArrow(expect, "form string, n bigint, path array<string>, weight double")
        share = F.col("n") * F.col("weight") / F.sum("weight").over(Window.partitionBy("form"))
        sums = {r.step: r.n for r in each.withColumn("share", share).select("share", F.explode("path").alias("step")).groupBy("step").agg(F.sum("share").alias("n")).toLocalIterator()}
        costs = {c: -math.log((sums.get(" ".join(c), 0.0) + 0.5) / (total + 1)) for c in CONFUSIONS}
    return costs


def _misread(found: DataFrame, forms: DataFrame, words: DataFrame) -> DataFrame:
    """``row_no, form, prev, next, printed, always``: the misread words of each text and what they stand for, ``always`` or between those neighbours.

    A form that is rare by itself is misread wherever it stands; neighbours
    choose among several words it may stand for. A contested word is misread
    where the neighbours' log odds for a rival outweigh the cost of the
    confusion, its own occurrence not counted.
    """
    costs = _confusion_costs(forms, words)
    hits = cut(found.select("row_no", F.explode("hits").alias("h")).select("row_no", "h.*"))
    met = salted_join(hits, forms, ["form"])
    plain = met.where("not contested and size(choices) = 1").select("row_no", "form", "prev", "next", "printed", F.lit(True).alias("always"))
    open_ = met.where("contested or size(choices) > 1")
    left = hits.groupBy(F.col("prev").alias("a"), F.col("form").alias("w")).agg(F.count_distinct("row_no").alias("n"))
    right = hits.groupBy(F.col("form").alias("w"), F.col("next").alias("b")).agg(F.count_distinct("row_no").alias("n"))
    asked = open_.select("form", "prev", "next", "contested", "choices").distinct().withColumn("v", F.explode(F.when(F.col("contested"), F.concat(F.array("form"), F.col("choices"))).otherwise(F.col("choices"))))
    l, r = left.withColumnRenamed("n", "n_left"), right.withColumnRenamed("n", "n_right")
    asked = asked.join(l, (F.col("prev") == F.col("a")) & (F.col("v") == l["w"]), "left").drop("a", "w").join(r, (F.col("next") == F.col("b")) & (F.col("v") == r["w"]), "left").drop("b", "w")
    asked = asked.join(words.select(F.col("word").alias("v"), "n_rows"), "v", "left")
    grouped = asked.groupBy("form", "prev", "next", "contested").agg(F.collect_list(F.struct("v", F.coalesce("n_left", F.lit(0)).alias("l"), F.coalesce("n_right", F.lit(0)).alias("r"), F.coalesce("n_rows", F.lit(0)).alias("n"))).alias("options"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for form, contested, options in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                odds = []
                for o in options:
                    own = o["v"] == form
                    near = math.log(max(0, o["l"] - own) + 0.5) + math.log(max(0, o["r"] - own) + 0.5)
                    # neighbours on both sides must speak for a rival; a word nowhere else seen there may still be right
                    steps = None if own else confused(o["v"], form)
                    if own:
                        odds.append((near, o["n"], o["v"]))
                    elif steps and (not contested or min(o["l"], o["r"]) >= LEAST_COUNT):
                        odds.append((near - sum(costs[s] for s in steps) + (0.0 if contested else math.log(max(1, o["n"]))), o["n"], o["v"]))
                best = max(odds, default=(0.0, 0, form))
                out.append(best[2] if best[2] != form else None)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.string())], names=["form", "prev", "next", "printed"])

    decided = grouped.mapInArrow(decide, "form string, prev string, next string, printed string").where("printed is not null")
    return plain.unionByName(salted_join(open_.select("row_no", "form", "prev", "next"), decided, ["form", "prev", "next"]).select("row_no", "form", "prev", "next", "printed", F.lit(False).alias("always")))


def page_faults(records: DataFrame) -> DataFrame:
    """``row_no, kind``: each kind of fault of a record's ``output`` once (``hyphenation``, ``ocr``, ``header``, ``page_number``).

    Null, empty and clean outputs give no rows; without pages no line counts as
    a page number; a null title is taken from the volume. Copies of a row are
    cases each, but do not make a misread word more frequent: those are counted
    over different outputs and questions, the words they stand for over all
    rows. Texts are read twice, to count words and to look for misread ones;
    what a filter of fixed size lets through is joined to the misread forms, so
    neither the vocabulary nor the forms are broadcast.
    """
    _, _, forms, words, found = _found(records)
    ocr = _misread(found, forms, words).select("row_no").distinct().select("row_no", F.lit("ocr").alias("kind"))
    return found.select("row_no", F.explode("kinds").alias("kind")).distinct().unionByName(ocr)


_LIST_LINE = re.compile(r"^\s*(?:[-*•]\s|\d{1,3}[.)]\s|```|\$ |[\w.]+=\S+ \(\d+\)|(?:[0-9a-fA-F]{2,8}[\s:]+){3,}|\W*[\d\s]+$)|\t")


def reflowed(lines: list[str]) -> str:
    """Lines joined to paragraphs; blank lines, lists and lines of numbers or code keep their ends.

    Only broken lines are joined: those that no sentence end closes, or that
    are about as long as the longest of their paragraph.
    """
    out: list[str] = []
    widest = 0
    for line in lines:
        s = line.strip()
        if not s or _LIST_LINE.search(line):
            out.append(line.rstrip())
            widest = 0
        elif out and out[-1] and widest and not _LIST_LINE.search(out[-1]) and (not _ended(out[-1]) or widest < 100):
            out[-1] += " " + s
            widest = max(widest, len(s))
        else:
            out.append(s)
            widest = len(s)
    return "\n".join(out)


_WORDS = re.compile(r"[^\W_]+(?:[’'][^\W_]+)*")


def _respelled(text: str, misread: list[dict]) -> str:
    """Misread words replaced in their case: those that are misread wherever they stand, others between the neighbours they were found with."""
    anywhere = {m["form"]: m["printed"] for m in misread if m["always"]}
    between = {(m["prev"], m["form"], m["next"]): m["printed"] for m in misread if not m["always"]}
    words = [(m.start(), m.group()) for m in _WORDS.finditer(text)]
    low = ["", *(w.lower() for _, w in words), ""]
    out, at = [], 0
    for i, (start, old) in enumerate(words):
        word = anywhere.get(low[i + 1]) or between.get((low[i], low[i + 1], low[i + 2]))
        if word:
            out += [text[at:start], word.upper() if old.isupper() and len(old) > 1 else word.capitalize() if old[0].isupper() or (not old[0].isalpha() and old[1:2].isupper()) else word]
            at = start + len(old)
    return "".join([*out, text[at:]])


def repaired_pages(records: DataFrame) -> DataFrame:
    """``row_no, kinds, text``: every faulty record's continuous text, without page furniture, word breaks and misread words.

    Candidates for a misread word come from the whole vocabulary; of several the
    context decides: the words before and after it, the cost of the confusions
    as learnt from the corpus, then the corpus frequency. Records without a
    fault give no rows; else as ``page_faults``.
    """
    texts, known, forms, words, found = _found(records)
    ocr = _misread(found, forms, words).groupBy("row_no").agg(F.collect_set(F.struct("prev", "form", "next", "printed", "always")).alias("misread"))
    faulty = found.groupBy("row_no").agg(F.first("kinds").alias("kinds")).join(ocr, "row_no", "left").where("size(kinds) > 0 or misread is not null").select("row_no", "misread")
    src = salted_join(texts, faulty, ["row_no"]).select(*texts.columns, "misread")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for (row, page), misread in zip(_checked(b, known), b.column(6).to_pylist(), strict=True):
                text = reflowed(page.lines)
                if misread:
                    page.kinds.add("ocr")
                    text = _respelled(text, misread)
                rows.append((row, sorted(page.kinds), text))
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.string())], names=["row_no", "kinds", "text"])

    return src.mapInArrow(run, "row_no bigint, kinds array<string>, text string")
