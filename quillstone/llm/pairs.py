"""Problem 4: defective answers of question-answer pairs, by labelling functions and a label model."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.runtime import cut, salted_join

from . import label_model, truncation
from .wordstats import EndingModel, count_words, frequent, is_empty, plain_words, visible

DEFECTS = ("empty", "refusal", "copy", "language", "truncated")
#: Votes per defect, in order of the labelling functions, with the expected share of (positives, negatives) each fires on.
FUNCTIONS = {
    "empty": (("blank or stand-in", 0.95, 0.0005), ("hardly a letter", 0.8, 0.001)),
    "refusal": (("declining words", 0.95, 0.001), ("short", 0.98, 0.45), ("same words for other questions", 0.7, 0.03), ("nothing beyond the declining sentences", 0.9, 0.002)),
    "copy": (("same letters", 0.9, 0.0005), ("only the question's words", 0.9, 0.001), ("covers the question", 0.97, 0.01)),
    "language": (("words", 0.95, 0.003), ("letters", 0.9, 0.02), ("volume", 0.9, 0.02)),
    "truncated": (("mark of omission", 0.25, 0.0005), ("no sentence end", 0.6, 0.005), ("stump or seldom a last word", 0.6, 0.01), ("log odds of the ending", 0.95, 0.003)),
}
PRIOR = {"empty": 0.02, "refusal": 0.01, "copy": 0.01, "language": 0.01, "truncated": 0.03}
#: Posteriors above which a label is kept: those of the best F1 on planted defects (``best_cutoffs``; figures in the README).
CUTOFF = {"empty": 0.5, "refusal": 0.5, "copy": 0.5, "language": 0.5, "truncated": 0.5}
#: The language classifier is fitted on at most this many rows per language.
SAMPLE_PER_LANGUAGE = 1500

#: A word tells of a language if it makes up at least this share of its sample.
_WORD_SHARE = 2e-4
_WORDS = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+)*").findall
#: Words by which English, German, French and Spanish answers decline, in lower case.
_DECLINES = re.compile(
    r"\b(?:i|we)(?: am|’m|'m| are|’re|'re)? (?:must |have to |will have to )?(?:respectfully |politely )?(?:unable|not able|not permitted|not allowed|declin\w+|refus\w+|sorry)\b"
    r"|\bi (?:can(?:’|'|no)t|cannot|can not|won[’']t|will not|could not|may not)(?: be able)? (?:to )?(?:help|assist|answer|provide|comply|discuss|do|share|respond|support|describe|fulfil)"
    r"|\bi (?:have|need) to decline\b|\bagainst (?:the|our|my) (?:usage )?(?:policy|policies|guidelines|rules)\b|\bguidelines do not allow\b|\bnot (?:permitted|allowed|authori[sz]ed) to\b|\bas an? (?:ai|language model|assistant)\b|\bunable to (?:provide|help|assist|answer)\b"
    r"|\btut mir leid\b|\bkann ich (?:\w+ ){0,5}nicht(?:s)?\b|\bich kann (?:\w+ ){0,5}nicht\b|\bdarf ich (?:\w+ ){0,5}(?:keine?|nicht)\b|\bich darf (?:\w+ ){0,5}(?:keine?|nicht)\b|\bsprachmodell\b|\bablehnen\b|\bnicht helfen\b|\bsicherheitsgründen\b|\bverweiger\w+"
    r"|\bdésolée?s?\b|\bne (?:peux|puis|pouvons) pas\b|\bdécliner\b|\bpas autorisée?\b|\bmodèle de langu(?:e|age)\b|\bm[’']est impossible\b|\brefuser\b|\bpas en mesure\b"
    r"|\blo siento\b|\bno (?:me )?(?:puedo|podemos|es posible)\b|\b(?:debo|tengo que) (?:rechazar|declinar)\b|\bmodelo de lenguaje\b|\bno (?:estoy|tengo) (?:autorizad[oa]|permitido)\b|\bno se me permite\b|\brechazar esta\b",
)
_SPLIT = re.compile(r"(?<=[.!?])\s+")
_SPOKEN = re.compile(r"[“\"«„][^”\"»“]{5,200}[,.!?]?[”\"»“],?\s+\w+")
_LISTING = re.compile(r"^\s*(?:[-*•]?\s*[\w.]+\s*=\s*\S+.*|\W*[0-9a-fA-F]{1,8}(?:[\s:|,;.-]+[0-9a-fA-F]{1,8})*\W*|[A-Za-z0-9+/]{16,}={0,2}|[$#>`|\\{}<].*|.*[|\t].*[|\t].*|\W*|.*[{};]\s*)$")
_KEYWORDS = re.compile(r"^[^.!?:]{2,40}:\s*[^.!?,]+(?:,\s*[^.!?,]+){2,}$")
_PREFIX = re.compile(r"^\s*(?:q|question|frage|pregunta|f|p)\s*[:.]\s*", re.I)


class LanguageModel:
    """Naive Bayes over words and over letter triples; fitted on labelled texts."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        words = {x: Counter(w for t in ts for w in _WORDS(t.lower())) for x, ts in texts.items()}
        triples = {x: Counter(t[i : i + 3] for w, n in c.items() for t in (f" {w} ",) for i in range(len(t) - 2) for _ in range(min(n, 20))) for x, c in words.items()}
        self.words, self.triples = self._table(words, _WORD_SHARE), self._table(triples, 0.0)
        self.words = {w.encode(): v for w, v in self.words.items()}
        self.known = frozenset(self.words)

    def _table(self, counts: dict[str, Counter], share: float) -> dict[str, tuple[float, ...]]:
        """Log probabilities by language of what makes up at least ``share`` of one language, and occurs at least three times."""
        totals = {x: sum(c.values()) + 1 for x, c in counts.items()}
        out = {}
        for k in set().union(*counts.values()) if counts else ():
            if any(c[k] >= max(3, share * totals[x]) for x, c in counts.items()):
                out[k] = tuple(math.log((counts[x][k] + 0.3) / totals[x]) for x in self.languages)
        return out

    def by_words(self, words: list[bytes]) -> tuple[str | None, float]:
        """The likeliest language by the words known, and its log odds against the next."""
        table = self.words
        found = [table[w] for w in self.known.intersection(words)]
        return self._best([sum(x) for x in zip(*found, strict=True)], len(found))

    def by_triples(self, words: list[bytes]) -> tuple[str | None, float]:
        """The same by letter triples."""
        table, found = self.triples, []
        for w in set(words):
            t = f" {w.decode()} "
            found += [v for i in range(len(t) - 2) if (v := table.get(t[i : i + 3])) is not None]
        return self._best([sum(x) for x in zip(*found, strict=True)], len(found))

    def _best(self, sums: list[float], n: int) -> tuple[str | None, float]:
        if not n or len(sums) < 2:
            return (self.languages[0] if self.languages and n else None), 0.0
        order = sorted(range(len(sums)), key=lambda i: -sums[i])
        return self.languages[order[0]], sums[order[0]] - sums[order[1]]


def _languages(manifest: DataFrame) -> DataFrame:
    return manifest.where("output_json is not null and lang is not null").groupBy(F.col("output_json").alias("source_file")).agg(F.max_by("lang", F.struct("generated_at", "manifest_row")).alias("lang"))


def sampled(records: DataFrame, manifest: DataFrame, per_language: int) -> DataFrame:
    """``lang, t``: of each manifest language the ``per_language`` rows of the lowest hash of ``row_no``, or all where there are fewer.

    Rows are filtered by a hash threshold that leaves a few more than that, of
    each language alike, before the lowest are ranked.
    """
    latest = cut(_languages(manifest))
    sizes = records.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).join(latest, "source_file").groupBy("lang").agg(F.sum("n").alias("n_lang"))
    # 2^63 times the share of the language's rows wanted, with room for chance
    most = F.least(F.lit(1.0), (F.lit(float(per_language)) + 6 * math.sqrt(per_language) + 20) / F.col("n_lang")) * float(2**63)
    h = F.abs(F.xxhash64("row_no").cast("double"))
    rows = records.select("row_no", "source_file", F.concat_ws("\n", "input", "alt_question_1", "summary", "output").alias("t"))
    chosen = salted_join(rows, latest.join(sizes, "lang").select("source_file", "lang", most.alias("most")), ["source_file"]).where(h <= F.col("most")).withColumn("h", h)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "row_no"))
    return chosen.select("lang", "t", rank.alias("rank")).where(F.col("rank") <= per_language).select("lang", "t")


def language_model(records: DataFrame, manifest: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fitted on at most ``per_language`` rows of each manifest language (a documented bound), see ``sampled``."""
    texts: dict[str, list[str]] = {}
    for r in sampled(records, manifest, per_language).toLocalIterator():
        texts.setdefault(r.lang, []).append(r.t)
    return LanguageModel(texts)


def _signature(words: list[bytes], question: set[bytes]) -> bytes:
    """The answer with the question's words blanked."""
    return b" ".join(b"#" if w in question else w for w in words)


def last_line(text: str) -> str:
    """The last line that is not blank, stripped."""
    return text.rstrip().rpartition("\n")[2].strip()


def _line_key(line: str) -> int:
    return xxhash.xxh3_64_intdigest(re.sub(r"\s+", " ", re.sub(r"\d+", "0", line.lower())).strip()) - (1 << 63)


class Question:
    """A pair's question: its words, and the language they are of."""

    def __init__(self, text: str, languages: LanguageModel):
        self.words = plain_words(text)
        self.set = set(self.words)
        self.language = None
        if len(self.words) >= 3:
            language, odds = languages.by_words(self.words)
            self.language = language if odds > 1.5 else None


def judge_pair(question: Question, answer: str | None, group: str, endings: EndingModel, languages: LanguageModel) -> dict:
    """Votes of the labelling functions that need no other record, by defect."""
    seen = visible(answer)
    words = plain_words(seen)
    empty = is_empty(answer, seen)
    letters = len(words) > 3 or any(map(str.isalpha, seen))
    out = {"empty": [int(empty), None if empty and letters else int(not letters)]}
    # refusal: the answer opens by declining, apologising or pointing elsewhere and mostly does so; speech within a story is none
    short = len(words) <= 45
    declines = only = False
    end = m.end() if (m := _SPLIT.search(seen)) else len(seen)
    end = m.start() if (m := _SPLIT.search(seen, end)) else len(seen)
    declines = bool(_DECLINES.search(seen[:end].lower()))
    if declines and not _SPOKEN.search(seen):
        sentences = [x for x in _SPLIT.split(seen.lower()) if x.strip()]
        only = sum(map(bool, map(_DECLINES.search, sentences))) * 2 >= len(sentences)
        declines = only or short
    else:
        declines = False
    out["refusal"] = [int(declines), 1 if short else None if only else 0, None, int(only)]
    # copy: an answer that has few of the question's words cannot be one
    same = contained = covers = False
    asked = question.set
    if len(asked.intersection(words)) >= 0.6 * len(asked):
        bare = plain_words(_PREFIX.sub("", seen)) if _PREFIX.match(seen) else words
        a, q = b"".join(bare), b"".join(question.words)
        said = set(bare)
        same = bool(q) and len(a) >= len(q) and a == q * (len(a) // len(q))
        contained = len(words) >= 3 and bool(said) and len(said - asked) <= len(said) // 20 and len(said) >= 0.6 * len(asked)
        covers = bool(asked) and len(asked & said) >= 0.85 * len(asked) and len(said) <= 1.3 * len(asked) + 2
    out["copy"] = [int(same), int(contained), int(covers)]
    # language: letters are asked only where words don't settle it
    spoken = None
    if len(words) >= 4 and len(question.words) >= 3:
        lq = question.language
        la, ma = languages.by_words(words)
        ta = mt = None
        if lq and (la != lq or ma <= 3.0):
            ta, mt = languages.by_triples(words)
        out["language"] = [int(la != lq and ma > 3.0) if lq and la else None, int(ta != lq and mt > 3.0) if ta else None, None]
        spoken = la if la and ma > 3.0 else None
    else:
        out["language"] = [0, 0, None]
    # truncated
    e = endings.judge(answer, group, seen)
    tail = last_line(seen) if group == "o" and e.kind == "open" else ""
    listing = bool(tail) and bool(_LISTING.match(tail) or e.stump < 6 and _KEYWORDS.match(tail))
    score = e.score
    if group == "o":
        score = -8.0 if listing else {"open": max(1.5, score), "marked": score, "terminal": score - 0.5, "empty": -20.0}[e.kind]
    out["truncated"] = [int(e.kind == "marked" and e.score > 0), int(e.kind == "open" and not listing), int(not listing and e.stump >= 6), int(score > 0.0)]
    return {
        "votes": out,
        "signature": xxhash.xxh3_64_intdigest(_signature(words, question.set)) - (1 << 63) if (short or only) and 2 <= len(words) else None,
        "tail": _line_key(tail) if tail and not listing else None,
        "spoken": spoken,
        "ending": (len(answer or ""), len(e.body), e.kind, e.score),
    }


def pair_votes(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """``row_no, field`` and, per defect, the votes of all labelling functions (-1 abstains) of every pair with a question."""
    spark = records.sparkSession
    records = records.select("row_no", "source_file", *truncation.GROUPS, "output")
    manifest = manifest.select("manifest_row", "generated_at", "output_json", "lang")
    counts = count_words(records, truncation.GROUPS | {"output": ""})
    known = spark.sparkContext.broadcast(frequent(cut(counts)))
    languages = spark.sparkContext.broadcast(language_model(records, manifest))
    src = records.where("alt_question_1 is not null").select("row_no", "source_file", *(F.col(c).cast("string").alias(c) for c in ("alt_question_1", "summary", "output")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings, model = EndingModel(known.value), languages.value
        for b in batches:
            rows = []
            for i, (question, summary, output) in enumerate(zip(*(b.column(c).to_pylist() for c in range(2, 5)), strict=True)):
                if not visible(question):
                    continue
                asked = Question(question, model)
                for field, group, answer in (("summary", "s", summary), ("output", "o", output)):
                    j = judge_pair(asked, answer, group, endings, model)
                    rows.append((i, field, j["signature"], j["tail"], xxhash.xxh3_64_intdigest(question) - (1 << 63), *j["ending"], j["spoken"], *([-1 if v is None else v for v in j["votes"][d]] for d in DEFECTS)))
            cols = list(zip(*rows, strict=True)) or [[]] * (10 + len(DEFECTS))
            take = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(cols[1], pa.string()), *(pa.array(cols[k], pa.int64()) for k in (2, 3, 4)), *(pa.array(cols[k], t) for k, t in zip((5, 6, 7, 8, 9), (pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.string()), strict=True)), *(pa.array(c, pa.list_(pa.int8())) for c in cols[10:])],
                names=["row_no", "source_file", "field", "signature", "tail", "question", "length", "body", "kind", "score", "spoken", *DEFECTS],
            )

    schema = "row_no bigint, source_file string, field string, signature bigint, tail bigint, question bigint, length int, body int, kind string, score double, spoken string, " + ", ".join(f"{d} array<tinyint>" for d in DEFECTS)
    votes = cut(src.mapInArrow(run, schema))
    # the same short answer to different questions; a last line that ends other records of the file too is a notice, not a stump
    volumes = _languages(manifest).withColumnRenamed("lang", "volume")
    stock = votes.where("signature is not null").select("signature", "question").distinct().groupBy("signature").agg(F.count(F.lit(1)).alias("n_questions")).where("n_questions >= 4")
    notices = votes.where("tail is not null").groupBy("source_file", "tail").agg(F.count_distinct("question").alias("n_tails")).where("n_tails >= 2")
    limits = truncation.field_limits(votes.where("field = 'summary' and kind <> 'empty'"))
    out = truncation.weigh(salted_join(votes, volumes, ["source_file"], "left"), limits).withColumn("is_cut", F.col("is_cut") & (F.col("kind") != "empty"))
    out = salted_join(salted_join(out, stock, ["signature"], "left"), notices, ["source_file", "tail"], "left")
    lv = F.col("language")
    other = F.when(F.col("volume").isNull() | (lv[0] < 0), F.lit(-1)).otherwise(F.coalesce((F.col("spoken") != F.col("volume")).cast("int"), F.lit(0))).cast("tinyint")
    repeated = F.when(F.col("signature").isNull(), F.lit(0)).otherwise(F.coalesce((F.col("n_questions") >= 4).cast("int"), F.lit(0))).cast("tinyint")
    notice = F.col("n_tails").isNotNull()
    zero = F.array(*(F.lit(0).cast("tinyint") for _ in FUNCTIONS["truncated"]))
    t = F.col("truncated")
    with_limits = F.when(F.col("field") == "summary", F.array(t[0], t[1], t[2], F.coalesce(F.col("is_cut"), F.lit(False)).cast("tinyint"))).otherwise(F.when(notice, zero).otherwise(t))
    r = F.col("refusal")
    return out.select("row_no", "field", "empty", F.array(r[0], r[1], repeated, r[3]).alias("refusal"), "copy", F.array(lv[0], lv[1], other).alias("language"), with_limits.alias("truncated"))


def pair_labels(records: DataFrame, manifest: DataFrame, cutoffs: dict[str, float] = CUTOFF) -> DataFrame:
    """Every label of every answer: ``row_no, field, defect, posterior``; an answer may have several.

    For each defect a label model is fitted to how often each combination of
    votes occurs (a handful of combinations, all pairs counted); a label is
    kept where its posterior exceeds the defect's cutoff. Rows with a null or
    blank ``alt_question_1`` are no pairs. Copies of a row are pairs each; an
    empty table gives no rows. A posterior belongs to a combination of votes,
    so it is looked up in a map of those combinations.
    """
    votes = cut(pair_votes(records, manifest))
    labels = []
    for d in DEFECTS:
        patterns = {tuple(None if v < 0 else v for v in r.v): r.n for r in votes.groupBy(F.col(d).alias("v")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
        if not patterns:
            continue
        share, rates = label_model.fit(patterns, PRIOR[d], [(h, f) for _, h, f in FUNCTIONS[d]])
        kept = {p: x for p in patterns if (x := label_model.posterior(p, share, rates)) > cutoffs[d]}
        if not kept:
            continue
        entries = [x for p, post in kept.items() for x in (F.lit(" ".join(str(-1 if v is None else v) for v in p)), F.lit(post))]
        labels.append(F.struct(F.lit(d).alias("defect"), F.create_map(*entries)[F.array_join(F.col(d).cast("array<string>"), " ")].alias("posterior")))
    if not labels:
        return votes.select("row_no", "field", F.lit("").alias("defect"), F.lit(0.0).alias("posterior")).where("false")
    return votes.select("row_no", "field", F.explode(F.array(*labels)).alias("x")).select("row_no", "field", "x.defect", "x.posterior").where("posterior is not null")


def pair_defects(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """One defect per defective answer, ``row_no, field, defect``: the first that holds in the order of ``DEFECTS``."""
    rank = F.array_position(F.array(*map(F.lit, DEFECTS)), F.col("defect"))
    return pair_labels(records, manifest).groupBy("row_no", "field").agg(F.min_by("defect", rank).alias("defect"))


def best_cutoffs(labels: DataFrame, truth: DataFrame) -> dict[str, tuple[float, float]]:
    """``(cutoff, F1)`` per defect: the posterior above which labels agree best with ``truth`` (``row_no, field, defect``).

    For validation on labelled rows. Posteriors belong to combinations of
    votes, so there are few different ones; the cutoff lies midway between two.
    ``labels`` as of ``pair_labels`` with every posterior kept.
    """
    known = truth.select("row_no", "field", "defect", F.lit(1).alias("t"))
    rows = labels.join(known, ["row_no", "field", "defect"], "full_outer").groupBy("defect", F.coalesce("posterior", F.lit(0.0)).alias("p")).agg(F.count("t").alias("true"), F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for d in sorted({r.defect for r in rows}):
        mine = sorted(((r.p, r.true, r.n) for r in rows if r.defect == d), reverse=True)
        total, hit, said, best = sum(t for _, t, _ in mine), 0, 0, (0.0, 1.0)
        for i, (p, t, n) in enumerate(mine):
            hit, said = hit + t, said + n
            below = mine[i + 1][0] if i + 1 < len(mine) else 0.0
            best = max(best, (2 * hit / (said + total), (p + below) / 2))
        out[d] = (best[1], best[0])
    return out
