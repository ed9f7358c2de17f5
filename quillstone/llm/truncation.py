"""Problem 3: values cut off by a field limit or on the way."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.runtime import cut, salted_join

from .wordstats import EndingModel, count_words, frequent

FIELDS = ("summary", "alt_question_2")
#: Log odds of a cut where neither the length nor the ending says anything.
PRIOR = -2.2
#: Log odds above which a value counts as cut.
CUTOFF = 0.0
#: A length is a limit a priori with odds of one to this many.
LIMIT_ODDS = 400


def _normal_tail(z: float) -> float:
    return max(1e-12, 0.5 * math.erfc(z / math.sqrt(2)))


def fit_censored(moments: tuple[float, float, float], limit: float, censored: float) -> tuple[float, float]:
    """Mean and deviation of log lengths by maximum likelihood, ``censored`` more values known only to reach ``limit``.

    ``moments``: number, sum and sum of squares of the whole values' log
    lengths, all that a round needs. Expectation-maximisation: values beyond the
    limit are replaced by the first two moments of the normal tail until the
    estimate stands.
    """
    n, one, two = moments
    total = max(1, n + censored)
    mean = (one + limit * censored) / total
    var = (two - 2 * mean * one + mean * mean * n + (limit - mean) ** 2 * censored) / total
    sd = max(0.08, math.sqrt(max(0.0, var)))
    if n < 3:
        return max(mean, limit), max(sd, 0.3)
    for _ in range(60):
        z = (limit - mean) / sd
        hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / _normal_tail(z)
        m1 = mean + sd * hazard
        m2 = sd * sd * max(0.02, 1 - hazard * (hazard - z))
        new = (one + m1 * censored) / total
        var = (two - 2 * new * one + new * new * n + ((m1 - new) ** 2 + m2) * censored) / total
        done = abs(new - mean) < 1e-4
        mean, sd = new, min(2.0, max(0.08, math.sqrt(max(0.0, var))))
        if done:
            break
    return mean, sd


def limit_posterior(at: int, stuck: int, beyond: int, moments: tuple[float, float, float]) -> float | None:
    """Posterior of a value of length ``at`` being censored there, if ``at`` is a field limit; else None.

    ``stuck`` values end there without an end and count as censored, ``beyond``
    are longer, ``moments`` are those of all values of the source and field. A
    length is a limit if the fitted distribution, with a share of values
    subject to the limit, explains those stuck and the longer ones better than
    no limit does, by more than the prior odds against any length.
    """
    x = math.log(at)
    n, one, two = moments
    mean, sd = fit_censored((n - stuck, one - stuck * x, two - stuck * x * x), x, stuck)
    z = (x - mean) / sd
    density = max(1e-9, math.exp(-z * z / 2) / (sd * math.sqrt(2 * math.pi)) / at)
    tail = _normal_tail(z)
    share = min(0.98, max(0.02, stuck / (stuck + beyond)))
    censored, free = share * tail, (1 - share) * density
    gain = stuck * math.log((censored + free) / density) + beyond * math.log(1 - share) - math.log(LIMIT_ODDS)
    return censored / (censored + free) if gain > 0 else None


GROUPS = {"summary": "s", "input": "q", "alt_question_1": "q", "alt_question_2": "q", "alt_question_3": "q"}


def values(records: DataFrame, fields: tuple[str, ...] = FIELDS, known=None) -> DataFrame:
    """One row per non-null value of a field: ``row_no, source_file, field, length, body, kind, score``; judged by corpus counts over all questions and summaries (or by the broadcast counts given)."""
    groups = GROUPS
    if known is None:
        known = records.sparkSession.sparkContext.broadcast(frequent(cut(count_words(records, groups))))
    src = records.select("row_no", "source_file", *(F.col(c).cast("string").alias(c) for c in fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = EndingModel(known.value)
        for b in batches:
            for c, field in enumerate(fields):
                at, lengths, bodies, kinds, scores = [], [], [], [], []
                for i, text in enumerate(b.column(2 + c).to_pylist()):
                    if text is None:
                        continue
                    e = model.judge(text, groups[field])
                    at.append(i)
                    lengths.append(len(text))
                    bodies.append(len(e.body))
                    kinds.append(e.kind)
                    scores.append(e.score)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array([field] * len(at)), pa.array(lengths, pa.int32()), pa.array(bodies, pa.int32()), pa.array(kinds, pa.string()), pa.array(scores, pa.float64())],
                    names=["row_no", "source_file", "field", "length", "body", "kind", "score"],
                )

    return src.mapInArrow(run, "row_no bigint, source_file string, field string, length int, body int, kind string, score double")


def cut_values(records: DataFrame, fields: tuple[str, ...] = FIELDS, known=None) -> DataFrame:
    """Every non-empty value with the log odds that it is cut: ``row_no, source_file, field, length, kind, posterior, score, is_cut``.

    Lengths of each source and field are counted, every length by itself; to
    each length at which values end without an end a right-censored log-normal
    distribution is fitted, from three sums over the source's lengths, so that
    the lengths of a source are independent rows. A value as long as a limit
    found there has the posterior of being censored, which is added, as log
    odds, to the evidence of its ending. Nulls,
    blanks, stand-ins and bare reasoning are no values here; a null
    ``source_file`` is a source of its own; copies of a row are cases each; an
    empty table gives no rows.
    """
    judged = cut(values(records, fields, known).where("kind <> 'empty'"))
    return weigh(judged, field_limits(judged)).select("row_no", "source_file", "field", "length", "kind", "posterior", F.col("odds").alias("score"), "is_cut")


def field_limits(judged: DataFrame) -> DataFrame:
    """``source_file, field, limits``: the lengths at which values judged already are cut, each with its posterior."""
    stuck = F.col("score") > 2
    spread = judged.select("source_file", "field", "length", stuck.alias("stuck")).unionByName(
        # a mark put at the end later lengthens the value: its length before that is a candidate too
        judged.where((F.col("kind") == "marked") & (F.col("body") != F.col("length"))).select("source_file", "field", F.col("body").alias("length"), stuck.alias("stuck"))
    )
    hist = spread.groupBy("source_file", "field", "length").agg(F.count(F.lit(1)).alias("n"), F.count_if("stuck").alias("k"))
    key = Window.partitionBy("source_file", "field")
    n, x = F.col("n"), F.log(F.col("length"))
    upto = F.sum("n").over(key.orderBy("length").rangeBetween(Window.unboundedPreceding, 8))
    sums = hist.select("source_file", "field", "length", "k", F.sum("n").over(key).alias("m0"), F.sum(n * x).over(key).alias("m1"), F.sum(n * x * x).over(key).alias("m2"), upto.alias("upto"))
    asked = sums.where("k >= 2 and length >= 8").select("source_file", "field", "length", "k", (F.col("m0") - F.col("upto")).alias("beyond"), "m0", "m1", "m2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [limit_posterior(at, k, beyond, moments) for at, k, beyond, *moments in zip(*(b.column(c).to_pylist() for c in range(2, 8)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, pa.float64())], names=["f", "g", "limit", "posterior"])

    found = asked.mapInArrow(run, "f string, g string, limit int, posterior double").where("posterior is not null")
    # at most a few limits per source and field, so the join does not multiply rows before the aggregate picks one
    return found.groupBy(F.col("f").alias("source_file"), F.col("g").alias("field")).agg(F.map_from_entries(F.collect_list(F.struct("limit", "posterior"))).alias("limits"))


def weigh(judged: DataFrame, limits: DataFrame) -> DataFrame:
    """``judged`` with ``posterior``, ``odds`` (of ending evidence and length together) and ``is_cut``; other columns stay."""
    p = F.coalesce(F.col("limits")[F.col("length")], F.col("limits")[F.col("body")], F.col("limits")[F.col("length") - 1])
    at_limit = salted_join(judged, limits, ["source_file", "field"], "left").withColumn("posterior", p).drop("limits")
    odds = F.when(F.col("posterior").isNull(), F.lit(PRIOR)).otherwise(F.greatest(F.lit(PRIOR), F.least(F.lit(4.0), F.log(F.col("posterior") / (1.0001 - F.col("posterior"))))))
    return at_limit.withColumn("odds", F.col("score") + odds).withColumn("is_cut", F.col("odds") > CUTOFF)


def cut_rates(values: DataFrame) -> DataFrame:
    """``source_file, field, n_values, n_cut, rate``: how often each source's values are cut."""
    return values.groupBy("source_file", "field").agg(
        F.count(F.lit(1)).alias("n_values"), F.count_if("is_cut").alias("n_cut"), (F.count_if("is_cut") / F.count(F.lit(1))).alias("rate")
    )
