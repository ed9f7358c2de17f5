"""Problem 9: evaluation items that stand in training documents (BM25 index with block-max WAND, exact verification)."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKS = regex.compile(r"\p{Mn}+").sub
_TAGS = re.compile(r"</?[A-Za-z][^<>\n]{0,80}>").sub
_WORDS = re.compile(r"[^\W_]+").findall
_QUESTION = regex.compile(r"\b(?:question|frage|pregunta|domanda|pergunta)\s*:", regex.I)
_BLOCK = 8
K1, B = 1.2, 0.75
#: Items are indexed and broadcast in blocks of at most this many, so that the index has a bounded size.
ITEMS_AT_ONCE = 20_000


def words(text: str) -> list[str]:
    """Runs of letters and digits without case and accents; tags are no words."""
    if not text.isascii():
        import unicodedata

        text = _MARKS("", unicodedata.normalize("NFKD", text))
    if "<" in text:
        text = _TAGS(" ", text)
    return _WORDS(text.casefold())


class ItemIndex:
    """Inverted index of items with BM25 weights, block maxima, and the least score that a run of ``run`` words gives."""

    def __init__(self, items: list[tuple[int, str]], run: int):
        self.run = run
        self.ids = [i for i, _ in items]
        self.texts = [words(t) for _, t in items]
        self.question = []
        for _, t in items:
            m = _QUESTION.search(t)
            self.question.append(len(words(t[: m.start()])) if m else len(words(t)))
        n, mean = len(items), sum(map(len, self.texts)) / max(1, len(items))
        df = Counter(w for t in self.texts for w in set(t))
        self.postings: dict[str, tuple[list[int], list[float], float, dict[int, float]]] = {}
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        weights = []
        for d, t in enumerate(self.texts):
            weights.append({w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(t) / mean)) for w, tf in Counter(t).items()})
            for w, s in weights[-1].items():
                lists[w].append((d, s))
        for w, ps in lists.items():
            blocks: dict[int, float] = {}
            for d, s in ps:
                blocks[d // _BLOCK] = max(blocks.get(d // _BLOCK, 0.0), s)
            self.postings[w] = ([d for d, _ in ps], [s for _, s in ps], max(s for _, s in ps), blocks)
        # an item's threshold: no passage holding a run of its words can score less
        self.least = [min((sum(weights[d][w] for w in set(t[k : k + run])) for k in range(len(t) - run + 1)), default=math.inf) - 1e-6 for d, t in enumerate(self.texts)]
        self.block_least = [min(self.least[k : k + _BLOCK]) for k in range(0, n, _BLOCK)]
        self.floor = min(self.least, default=math.inf)
        self.grams: list[set[tuple[str, ...]]] = [{tuple(t[k : k + run]) for k in range(len(t) - run + 1)} for t in self.texts]

    def candidates(self, passage: list[str]) -> list[int]:
        """Items whose BM25 score for the passage reaches their own threshold: document-at-a-time WAND with block maxima."""
        postings, least, block_least, floor = self.postings, self.least, self.block_least, self.floor
        terms = [postings[w] for w in set(passage) if w in postings]
        if sum(t[2] for t in terms) < floor:
            return []
        cursors = [[t[0][0], 0, t] for t in terms]
        out = []
        end = len(least)
        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                if c[0] >= end:
                    break
                bound += c[2][2]
                if bound >= floor:
                    pivot = k
                    break
            if pivot < 0:
                return out
            doc = cursors[pivot][0]
            block = doc // _BLOCK
            here = sum(c[2][3].get(block, 0.0) for c in cursors if c[0] < (block + 1) * _BLOCK)
            if here < block_least[block]:
                target = (block + 1) * _BLOCK
                moved = [c for c in cursors if c[0] < target]
            elif cursors[0][0] == doc:
                score = sum(c[2][1][c[1]] for c in cursors if c[0] == doc)
                if score >= least[doc]:
                    out.append(doc)
                target = doc + 1
                moved = [c for c in cursors if c[0] == doc]
            else:
                target = doc
                moved = [c for c in cursors if c[0] < doc]
            for c in moved:
                docs = c[2][0]
                k = c[1] = bisect_left(docs, target, c[1])
                c[0] = docs[k] if k < len(docs) else end

    def matches(self, text: str, passage: int = 48) -> list[tuple[int, int, int, bool]]:
        """``(item_id, words in runs, longest run, question reached)`` of every item with a run in ``text``.

        Passages overlap by ``run - 1`` words, so that every run lies wholly in one.
        """
        ws, run = words(text), self.run
        if len(ws) < run:
            return []
        found: dict[int, set[int]] = {}
        for start in range(0, max(1, len(ws) - run + 1), passage - run + 1):
            part = ws[start : start + passage]
            for d in self.candidates(part):
                grams = self.grams[d]
                hits = [start + k for k in range(len(part) - run + 1) if tuple(part[k : k + run]) in grams]
                if hits:
                    found.setdefault(d, set()).update(hits)
        out = []
        for d, hits in found.items():
            longest = length = 0
            last = -2
            for h in sorted(hits):
                length = length + 1 if h == last + 1 else run
                longest, last = max(longest, length), h
            covered = {w for h in hits for w in range(h, h + run)}
            t = self.texts[d]
            tail = {tuple(t[k : k + run]) for k in range(max(0, self.question[d] - run + 1), len(t) - run + 1)}
            asked = self.question[d] < len(t) and any(tuple(ws[h : h + run]) in tail for h in hits)
            out.append((self.ids[d], len(covered), longest, asked))
        return sorted(out)


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 10) -> DataFrame:
    """One row per document and item of which it holds at least ``run`` consecutive words.

    Columns: ``doc_id, item_id, n_words`` (words of the document inside such
    runs), ``longest_run, asks`` (a run reaches the item's question). Every
    passage of every document is a query against the index of items; each item
    has its own score threshold, the least that any of its runs can score, so
    retrieval is complete; the words are then compared. Null, empty and short
    texts have no runs, nor do items shorter than ``run``; copies of a document
    are cases each; repeated items are separate items. Documents are not
    shuffled. Items are taken in blocks of a bounded number, each a broadcast.
    """
    spark = documents.sparkSession
    known = items.where("text is not null").select("item_id", F.col("text").cast("string"))
    src = documents.where("text is not null").select("doc_id", F.col("text").cast("string"))
    n = known.count()
    blocks = max(1, -(-n // ITEMS_AT_ONCE))
    out = None
    for k in range(blocks):
        block = known if blocks == 1 else known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        index = spark.sparkContext.broadcast(sorted((r[0], r[1]) for r in block.toLocalIterator()))
        found = src.mapInArrow(_searcher(index, run), "doc_id bigint, item_id bigint, n_words int, longest_run int, asks boolean")
        out = found if out is None else out.unionByName(found)
    return out


_built: dict[int, ItemIndex] = {}


def _searcher(index, run: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash((run, tuple(index.value)))
        if key not in _built:
            _built.clear()
            _built[key] = ItemIndex(index.value, run)
        items = _built[key]
        for b in batches:
            rows = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in items.matches(t)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "n_words", "longest_run", "asks"])

    return search
