"""Problem 6: lines repeated across one source's documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import cut, salted_join

from .filters import bloom_bits, passed

_DIGITS = re.compile("[0-9]+").sub
_SPACES = re.compile(r"[^\S\n]+").sub
_LETTERS = 12
#: (bytes hashed at a position, positions of which the least hash is a landmark): chunks of 16 bytes on average, and short ones.
COARSE, FINE = (8, 31), (3, 3)
#: So many bytes of text are chunked at once.
_STREAM = 4 << 20
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _normal_lines(text: str) -> list[str]:
    """Lines in lower case, runs of digits as one sign, white space squeezed."""
    return [x.strip() for x in _SPACES(" ", _DIGITS("0", text.lower())).split("\n")]


def _enough_letters(line: str) -> bool:
    return len(line) >= _LETTERS and (sum(map(str.isalpha, line[:20])) >= _LETTERS or sum(map(str.isalpha, line)) >= _LETTERS)


def _least(h: np.ndarray, size: int, take=np.minimum) -> np.ndarray:
    """The least (or greatest) of every ``size`` neighbours, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        h = take(h[:-step], h[step:]) if len(h) > step else h[:0]
        have += step
    return h


def landmarks(data: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Positions whose rolling hash over ``gram`` bytes is the least of some ``window`` neighbouring positions.

    Whether a position is one depends on the bytes less than ``window`` before
    it and ``window + gram`` after it, and each ``window`` positions have one.
    """
    n = len(data) - gram + 1
    if n < window:
        return np.empty(0, np.int64)
    h = np.zeros(n, np.uint32)
    for i in range(gram):
        h *= np.uint32(0x01000193)
        h += data[i : i + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    least = _least(h, window)
    padded = np.concatenate([np.zeros(window - 1, np.uint32), least, np.zeros(window - 1, np.uint32)])
    return np.flatnonzero(_least(padded, window, np.maximum) == h)


class Stream:
    """A stream of text, cut by content into chunks; line ends are bytes as any other."""

    def __init__(self, raw: bytes):
        self.data = np.frombuffer(raw, np.uint8)
        n = len(raw)
        powers = np.full(n, _INVERSE, np.uint64)
        powers[:1] = 1
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.data.astype(np.uint64) * powers, out=self.sums[1:])
        powers = np.full(n, _FACTOR, np.uint64)
        powers[:1] = 1
        self.powers = np.cumprod(powers)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes from ``start`` to ``end``, whatever their place."""
        h = (self.sums[end] - self.sums[start]) * self.powers[start] + (end - start).astype(np.uint64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(32))).view(np.int64)

    def inside(self, start: np.ndarray, end: np.ndarray, scale: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Landmarks, and of each span the first and last that nothing outside the span can have set."""
        gram, window = scale
        marks = landmarks(self.data, gram, window)
        return marks, np.searchsorted(marks, start + window - 1), np.searchsorted(marks, end - gram - window + 1, "right") - 1

    def chunks(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per span (line) the hashes of the chunks that lie in it whatever stands around it, as ``(values, offsets)``.

        A chunk reaches from a landmark over the next one. Lines too short for a
        chunk of the coarse scale have one between landmarks of the fine scale,
        which every span of at least 12 bytes holds; so each repeated line
        repeats all chunks given for it.
        """
        marks, first, last = self.inside(start, end, COARSE)
        n = np.maximum(0, last - first)
        short = n == 0
        fine, a, b = self.inside(start[short], end[short], FINE)
        counts = np.where(short, 1, n)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        out = np.empty(offsets[-1], np.int64)
        if short.any():
            out[offsets[:-1][short]] = self.hashes(fine[a], fine[b] + FINE[0])
        if not short.all():
            long = ~short
            at = np.repeat(first[long] - offsets[:-1][long], n[long]) + (places := np.flatnonzero(np.repeat(long, counts)))
            out[places] = self.hashes(marks[at], marks[at + 1] + COARSE[0])
        return out, offsets


def _lines(records: DataFrame) -> DataFrame:
    """Every line with enough letters: ``row_no, source_file, chunk_id, line_no, key, pieces``."""
    src = records.select("row_no", "source_file", "chunk_id", F.col("output").cast("string")).where("output is not null")

    def flush(b: pa.RecordBatch, at: list, numbers: list, keys: list, starts: list, ends: list, stream: list) -> pa.RecordBatch:
        if at:
            values, offsets = Stream(b"\n".join([*stream, b""])).chunks(np.array(starts), np.array(ends))
        else:
            values, offsets = np.empty(0, np.int64), np.zeros(1, np.int32)
        take = pa.array(at, pa.int64())
        pieces = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
        return pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in range(3)), pa.array(numbers, pa.int64()), pa.array(keys, pa.binary()), pieces], names=["row_no", "source_file", "chunk_id", "line_no", "key", "pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: tuple[list, ...] = ([], [], [], [], [], [])
            at, numbers, keys, starts, ends, stream = parts
            size = 0
            for i, text in enumerate(b.column(3).to_pylist()):
                for n, line in enumerate(_normal_lines(text), 1):
                    raw = line.encode()
                    if _enough_letters(line):
                        at.append(i)
                        numbers.append(n)
                        keys.append(xxhash.xxh3_128_digest(raw))
                        starts.append(size)
                        ends.append(size + len(raw))
                    stream.append(raw)
                    size += len(raw) + 1
                if size > _STREAM:
                    yield flush(b, *parts)
                    for p in parts:
                        p.clear()
                    size = 0
            yield flush(b, *parts)

    return src.mapInArrow(run, "row_no bigint, source_file string, chunk_id string, line_no bigint, key binary, pieces array<bigint>")


def _made_of(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Lines all of whose pieces are among ``chunks`` (``source, piece``), and a few more: tested in place by a filter of fixed size."""
    bits = lines.sparkSession.sparkContext.broadcast(bloom_bits(chunks, F.col("source").bitwiseXOR(F.col("piece"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pieces, sources = b.column("pieces"), b.column("source").to_numpy()
            ends = pieces.offsets.to_numpy()
            if not len(sources):
                continue
            values = pieces.values.to_numpy()[ends[0] : ends[-1]]
            hit = passed(bits.value, values ^ np.repeat(sources, np.diff(ends)))
            yield b.take(pa.array(np.flatnonzero(np.logical_and.reduceat(hit, ends[:-1] - ends[0])), pa.int64()))

    return lines.mapInArrow(run, lines.schema)


def _found(records: DataFrame, least_docs: int, share: float) -> tuple[DataFrame, DataFrame]:
    """Candidate lines, and the repeated ones as ``source_file, key, n_docs``."""
    source, doc = F.xxhash64("source_file").alias("source"), F.xxhash64("chunk_id").alias("doc")
    lines = cut(_lines(records)).withColumn("source", source)
    docs = cut(records.where("chunk_id is not null").select("source_file", "chunk_id").distinct().groupBy("source_file").agg(F.count(F.lit(1)).alias("n_all")))
    of_source = docs.groupBy(source).agg(F.min("n_all").alias("n_all"))
    enough = (F.col("n_docs") >= least_docs) & (F.col("n_docs") >= F.col("n_all") * F.lit(share))

    # a chunk stands in no more documents than places, which are summed up per task; most chunks end here
    places = lines.where("chunk_id is not null").select("source", F.explode("pieces").alias("piece")).groupBy("source", "piece").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= least_docs)
    near = cut(_made_of(lines, salted_join(places, of_source, ["source"]).where(enough).select("source", "piece")))
    # the documents of the others; all that hold a repeated line are among these lines
    pieces = near.where("chunk_id is not null").select("source", doc, F.explode(F.array_distinct("pieces")).alias("piece")).distinct()
    counted = pieces.groupBy("source", "piece").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= least_docs)
    repeated = salted_join(counted, of_source, ["source"]).where(enough).select("source", "piece")
    candidates = cut(_made_of(near, repeated).select("row_no", "source_file", "chunk_id", "line_no", "key"))

    n = candidates.where("chunk_id is not null").select("source_file", "chunk_id", "key").distinct().groupBy("source_file", "key").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= least_docs)
    return candidates, salted_join(n, docs, ["source_file"]).where(enough).select("source_file", "key", "n_docs")


def repeated_lines(records: DataFrame, least_docs: int = 5, share: float = 0.08) -> DataFrame:
    """Lines to be removed, one row ``(row_no, source_file, line_no, n_docs)`` each.

    Every output is one stream, cut into chunks at landmarks of a rolling hash,
    not at line ends; different ``chunk_id`` are counted per source and chunk,
    once chunks with fewer places than that are gone. Chunks in at least
    ``least_docs`` documents and ``share`` of all documents of their source are
    mapped back to the lines they lie in; a line made of such chunks only is a
    candidate, whose own documents are then counted exactly. Each chunk that counts for a line stands wherever the line does, so no line
    is missed (but for collisions of 64-bit hashes of documents). Null and empty
    outputs have no lines; a null ``source_file`` is a source of its own; a null
    ``chunk_id`` is no document but its lines are removed too. Copies of a row
    are cases each. Counts are partial sums over (source, chunk) and (source,
    line), so a source with a third of all rows is spread over all tasks.
    """
    candidates, hits = _found(records, least_docs, share)
    return salted_join(candidates, hits, ["source_file", "key"]).select("row_no", "source_file", "line_no", "n_docs")


def without_repeated_lines(records: DataFrame, least_docs: int = 5, share: float = 0.08) -> DataFrame:
    """``row_no, output, n_removed``: every record's output without its repeated lines (unchanged where there are none).

    A source's repeated lines are few (at most 1/``share`` times the lines of a
    document, on average), so they go to the records, and texts stay where they
    are. Lines are as in ``repeated_lines``; a null output stays null.
    """
    hits = _found(records, least_docs, share)[1].groupBy("source_file").agg(F.collect_set("key").alias("gone"))
    src = salted_join(records.select("row_no", "source_file", F.col("output").cast("string").alias("output")), hits, ["source_file"], "left").select("row_no", "output", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, removed = [], []
            for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                n = 0
                if text and gone:
                    keys = frozenset(gone)
                    kept = [raw for raw, line in zip(text.split("\n"), _normal_lines(text), strict=True) if not (_enough_letters(line) and xxhash.xxh3_128_digest(line.encode()) in keys)]
                    n = text.count("\n") + 1 - len(kept)
                    text = "\n".join(kept) if n else text
                texts.append(text)
                removed.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int32())], names=["row_no", "output", "n_removed"])

    return src.mapInArrow(run, "row_no bigint, output string, n_removed int")
