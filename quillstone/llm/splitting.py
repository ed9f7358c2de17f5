"""Problem 2: cutting oversized records at natural boundaries (content-defined chunking)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import token_count
from quillstone.runtime import salted_join

_TOKENS = regex.compile(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{White_Space}\x1c-\x1f]")
_ENDS = frozenset(".!?…。！？")
_CLOSERS = frozenset("\"'”’»)]")
_WINDOW = 8
_MULTIPLIER = np.uint64(0x9E3779B1)


def _rolling(tokens: list[str]) -> np.ndarray:
    """For each position i the hash of the ``_WINDOW`` tokens before it."""
    one = np.fromiter((zlib.crc32(t.encode()) for t in tokens), np.uint64, len(tokens))
    h = np.zeros(len(tokens) + 1, np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for back in range(_WINDOW):
            if back >= len(tokens):
                break
            h[back + 1 :] += one[: len(tokens) - back] * factor
            factor *= _MULTIPLIER
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _pauses(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """Strength of the pause before each token: 4 blank line, 3 sentence end, 2 line end, 1 clause mark, 0 none."""
    out = np.zeros(len(spans) + 1, np.int8)
    for i in range(1, len(spans)):
        a, b = spans[i - 1][1], spans[i][0]
        if a == b:
            continue
        gap = text[a:b]
        lines = gap.count("\n") or gap.count("\r")
        last = text[a - 1]
        if last in _CLOSERS and a >= 2:
            last = text[a - 2] if text[a - 2] in _ENDS else last
        out[i] = 4 if lines > 1 else 3 if last in _ENDS else 2 if lines else 1 if last in ";:,—–" else 0
    return out


def cut_points(text: str, spans: list[tuple[int, int]], least: int, most: int) -> list[int]:
    """Token positions at which ``text`` is cut into pieces of at most ``most`` tokens.

    A rolling hash over the last tokens marks landmarks, about one in ``most/8``
    positions. The first landmark at least ``least`` tokens after the last cut
    is moved to the nearest natural pause between the two limits (the stronger
    pause at equal distance, then the earlier). Without a landmark the strongest,
    last pause is taken; without a pause the landmark itself; without either the
    upper limit. As marks depend on nearby tokens only, an edit changes the
    pieces around it, and cuts fall together again at the next landmark.
    """
    n = len(spans)
    if n <= most:
        return []
    marks = _rolling([text[a:b] for a, b in spans]) % np.uint64(max(1, most // 8)) == 0
    pauses = _pauses(text, spans)
    cuts, start = [], 0
    while n - start > most:
        lo, hi = start + least, start + most
        found = np.flatnonzero(marks[lo : hi + 1])
        places = lo + np.flatnonzero(pauses[lo : hi + 1] >= 2)
        if not len(places):
            places = lo + np.flatnonzero(pauses[lo : hi + 1])
        if len(found) and len(places):
            mark = lo + int(found[0])
            cut = min(places.tolist(), key=lambda p: (abs(p - mark), -pauses[p], p))
        elif len(places):
            best = pauses[places].max()
            cut = int(places[pauses[places] == best][-1])
        else:
            cut = lo + int(found[0]) if len(found) else hi
        cuts.append(cut)
        start = cut
    return cuts


def split_text(text: str, cap: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """Parts of ``text`` as ``(char_start, core_start, char_end, n_tokens)``.

    ``core_start`` is where the part's own text begins, before it stand the last
    ``overlap`` tokens of the part before. The own texts joined give ``text``.
    No part has more than ``cap`` tokens. The overlap is at most half the cap.
    """
    cap = max(1, cap)
    spans = [m.span() for m in _TOKENS.finditer(text)]
    if len(spans) <= cap:
        return [(0, 0, len(text), len(spans))]
    overlap = min(max(0, overlap), cap // 2)
    most = cap - overlap
    cuts = [0, *cut_points(text, spans, max(1, most // 2), most), len(spans)]
    parts = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        first = max(0, a - overlap)
        parts.append((spans[first][0] if first else 0, spans[a][0] if a else 0, spans[b][0] if b < len(spans) else len(text), b - first))
    return parts


def _caps(status: DataFrame) -> DataFrame:
    return status.groupBy("source_file").agg(F.max_by("token_cap", F.struct("updated_at", "status_id")).alias("cap"), F.max_by("oversized_before", F.struct("updated_at", "status_id")).alias("recorded"))


def oversized(records: DataFrame, status: DataFrame) -> DataFrame:
    """Records with more tokens than their file's cap: ``row_no, source_file, chunk_start, chunk_end, output, cap, n_tokens``.

    The cap is that of the file's status row with the latest ``updated_at``
    (rows without one are ignored, the higher ``status_id`` wins a tie); no
    status or a null cap means no cap. Null and empty outputs are never over it.
    A text cannot have more tokens than characters, so shorter ones are dropped
    before tokens are counted.
    """
    caps = _caps(status.where("updated_at is not null")).where("cap is not null")
    least = caps.agg(F.min("cap").alias("least_cap"))  # a single row: texts below every cap are not joined at all
    rows = records.select("row_no", "source_file", "chunk_start", "chunk_end", F.col("output").cast("string").alias("output")).where("source_file is not null")
    rows = rows.crossJoin(F.broadcast(least)).where(F.length("output") > F.col("least_cap")).drop("least_cap")
    return (
        salted_join(rows, caps.select("source_file", "cap"), ["source_file"]).where(F.length("output") > F.col("cap"))
        .withColumn("n_tokens", token_count(F.col("output"))).where("n_tokens > cap")
    )


def split_oversized(records: DataFrame, status: DataFrame, profiles: DataFrame, profile: str = "resplit") -> DataFrame:
    """One row per part of every oversized record.

    Columns: ``row_no, source_file, chunk_start, chunk_end, part_index`` (from
    1), ``part_count, part_tokens, char_start, core_start, char_end`` (offsets
    in ``output``; what stands before ``core_start`` is overlap), ``part_text,
    n_tokens, token_cap``; ``with_file_counts`` adds the file's true number of
    oversized rows. Records under the cap, null and empty ones give no rows, as
    do empty tables; repeated rows are each split. The overlap is that of
    ``profile`` (0 when it is missing), at most half the cap. Only texts longer
    than the least cap are joined to their cap; cutting needs no shuffle.
    """
    overlap = profiles.where(F.col("profile") == profile).agg(F.coalesce(F.max("overlap_tokens"), F.lit(0)).alias("overlap_tokens"))
    over = oversized(records, status).crossJoin(F.broadcast(overlap))  # a single row
    src = over.select("row_no", "source_file", "chunk_start", "chunk_end", "n_tokens", "cap", "output", "overlap_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, index, count, tokens, offsets, texts = [], [], [], [], [], []
            for i, (text, cap, overlap) in enumerate(zip(b.column(6).to_pylist(), b.column(5).to_pylist(), b.column(7).to_pylist(), strict=True)):
                parts = split_text(text, cap, overlap)
                for k, (start, core, end, n) in enumerate(parts, 1):
                    at.append(i)
                    index.append(k)
                    count.append(len(parts))
                    tokens.append(n)
                    offsets.append((start, core, end))
                    texts.append(text[start:end])
            kept = [b.column(c).take(pa.array(at, pa.int64())) for c in range(6)]
            start, core, end = (pa.array([o[k] for o in offsets], pa.int32()) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(index, pa.int32()), pa.array(count, pa.int32()), pa.array(tokens, pa.int32()), start, core, end, pa.array(texts, pa.string())],
                names=["row_no", "source_file", "chunk_start", "chunk_end", "n_tokens", "token_cap", "part_index", "part_count", "part_tokens", "char_start", "core_start", "char_end", "part_text"],
            )

    schema = "row_no bigint, source_file string, chunk_start int, chunk_end int, n_tokens int, token_cap int, part_index int, part_count int, part_tokens int, char_start int, core_start int, char_end int, part_text string"
    return src.mapInArrow(run, schema)


def with_file_counts(parts: DataFrame) -> DataFrame:
    """``parts`` with ``oversized_before``: the file's number of oversized rows, aggregated before the join."""
    per_file = parts.where("part_index = 1").groupBy("source_file").agg(F.count(F.lit(1)).alias("oversized_before"))
    return salted_join(parts, per_file, ["source_file"])


def file_report(records: DataFrame, status: DataFrame) -> DataFrame:
    """Per file with a cap: ``source_file, token_cap, n_rows, oversized_before`` (true) and ``oversized_recorded`` (as in the status, maybe wrong or null)."""
    caps = _caps(status.where("updated_at is not null")).where("cap is not null")
    rows = records.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    over = oversized(records, status).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_over"))
    return caps.join(rows, "source_file", "left").join(over, "source_file", "left").select(
        "source_file", F.col("cap").alias("token_cap"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_over", F.lit(0)).alias("oversized_before"), F.col("recorded").alias("oversized_recorded")
    )
