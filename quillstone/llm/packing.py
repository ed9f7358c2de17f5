"""Problem 5: filling containers of fixed capacity (best-fit decreasing)."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.text import token_count

#: Salts of the rank within one volume and size, so that no key's rows meet in one task.
SALTS = 64


class OpenBins:
    """Open containers by remaining capacity, over which a segment tree finds the tightest that fits in O(log capacity)."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)
        self.ranges: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        if not room:
            return
        if not self.ranges[room]:
            i = room + self.size
            while i and not self.tree[i]:
                self.tree[i] = 1
                i >>= 1
        self.ranges[room].append((first, count))

    def tightest(self, need: int) -> int | None:
        """The least room >= ``need`` that a container has."""
        i = need + self.size
        if self.tree[i]:
            return need
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` containers of one range with that room, as (first, count)."""
        first, count = self.ranges[room].popleft()
        if count > most:
            self.ranges[room].appendleft((first + most, count - most))
            return first, most
        if not self.ranges[room]:
            i = room + self.size
            self.tree[i] = 0
            while i > 1:
                i >>= 1
                self.tree[i] = self.tree[2 * i] | self.tree[2 * i + 1]
        return first, count


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Packs a multiset of ``(size, count)`` with sizes 1..capacity.

    Gives runs ``(size, rank, n, per_bin, bin)``: of the items of that size,
    those of ranks ``rank .. rank+n-1`` go to containers ``bin``, ``bin+1``, ...
    with ``per_bin`` in each. The same containers as best-fit decreasing item by
    item: equal items fill the tightest container as long as they fit, so all
    containers of equal room are treated at once, and the work depends on the
    number of different sizes, not of items.
    """
    bins, opened, runs = OpenBins(capacity), 0, []
    for size, count in sorted(sizes, reverse=True):
        rank = 0
        while rank < count:
            left = count - rank
            room = bins.tightest(size)
            each = (room or capacity) // size
            want = max(1, left // each)
            each = min(each, left)
            if room is None:
                first, got, room = opened, want, capacity
                opened += want
            else:
                first, got = bins.take(room, want)
            runs.append((size, rank, got * each, each, first))
            bins.add(room - each * size, first, got)
            rank += got * each
    return runs


def _pieces(records: DataFrame, usable: int) -> DataFrame:
    items = records.select("row_no", "doc_id", "semantic_block_index", token_count(F.coalesce(F.col("output").cast("string"), F.lit(""))).alias("n_tokens"))
    n = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / usable)).cast("int")
    return (
        items.withColumn("piece_count", n).withColumn("piece_index", F.explode(F.sequence(F.lit(1), n)))
        .withColumn("token_start", (F.col("piece_index") - 1) * usable)
        .withColumn("token_end", F.least("n_tokens", F.col("piece_index") * usable))
        .withColumn("size", F.col("token_end") - F.col("token_start"))
    )


def usable_capacity(profiles: DataFrame, profile: str) -> int:
    """Capacity less reserve of a profile; the table is looked up for one row, the unique name."""
    row = profiles.where(F.col("profile") == profile).agg(F.max(F.col("capacity_tokens") - F.coalesce("reserved_tokens", F.lit(0))).alias("u")).first()
    if row is None or row.u is None or row.u < 1:
        raise ValueError(f"no profile {profile!r} with room")
    return row.u


def pack(records: DataFrame, usable: int) -> DataFrame:
    """Assigns each output to a container of its volume (``doc_id``).

    Columns: ``row_no, doc_id, piece_index, piece_count, token_start,
    token_end, size, container`` (from 0 within the volume). Tokens are runs of
    letters, digits and underscores, or other single characters. Only texts
    larger than a container are cut, into full pieces and a rest. Null, empty
    and blank outputs have size 0 and stand in container 0. Records without
    ``doc_id`` form one volume. Repeated rows are packed each; an empty table
    gives no rows.

    The packing of a volume depends only on how many pieces of each size it
    has, at most ``usable`` numbers, so that is all one task ever sees. Pieces
    get their rank within (volume, size) in two steps over salted keys and
    look their container up.
    """
    if not 1 <= usable:
        raise ValueError("usable capacity must be at least 1")
    pieces = _pieces(records, usable).withColumn("salt", F.pmod(F.xxhash64("row_no", "piece_index"), F.lit(SALTS)).cast("int"))
    keys = ["doc_id", "size", "salt"]
    salted = pieces.where("size > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    before = salted.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy("doc_id", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hist = salted.groupBy("doc_id", "size").agg(F.sum("n").alias("n")).groupBy("doc_id").agg(F.collect_list(F.struct("size", "n")).alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, rows = [], []
            for doc, sizes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got: dict[int, list[dict]] = {}
                for size, rank, n, each, first in best_fit_decreasing([(s["size"], s["n"]) for s in sizes], usable):
                    got.setdefault(size, []).append({"rank": rank, "n": n, "per_bin": each, "bin": first})
                docs += [doc] * len(got)
                rows += got.items()
            runs = pa.array([r for _, r in rows], pa.list_(pa.struct([(k, pa.int64()) for k in ("rank", "n", "per_bin", "bin")])))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), pa.array([s for s, _ in rows], pa.int32()), runs], names=["doc_id", "size", "runs"])

    # few bytes but much work a volume: spread over all cores whatever the size
    runs = hist.repartition(2 * hist.sparkSession.sparkContext.defaultParallelism, "doc_id").mapInArrow(run, "doc_id string, size int, runs array<struct<rank bigint, n bigint, per_bin bigint, bin bigint>>")
    offsets = before.join(runs.withColumnsRenamed({"doc_id": "d", "size": "s"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("s"))).select(*keys, "ahead", "runs")
    ranked = pieces.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("semantic_block_index", "row_no", "piece_index")) - 1)
    o = offsets.select(*(F.col(k).alias(f"_{k}") for k in keys), "ahead", "runs")
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("size") == F.col("_size")) & (F.col("salt") == F.col("_salt"))
    found = F.filter("runs", lambda x: (x["rank"] <= F.col("ahead") + F.col("r")) & (F.col("ahead") + F.col("r") < x["rank"] + x["n"]))[0]
    placed = ranked.join(o, on, "left").withColumn("x", found)
    return placed.select(
        "row_no", "doc_id", "piece_index", "piece_count", "token_start", "token_end", "size",
        F.coalesce(F.col("x.bin") + F.floor((F.col("ahead") + F.col("r") - F.col("x.rank")) / F.col("x.per_bin")), F.lit(0)).cast("bigint").alias("container"),
    )


def pack_report(packed: DataFrame, usable: int) -> DataFrame:
    """Per volume: pieces, tokens, containers, the least number of containers any packing needs by volume, and the fill."""
    per = packed.groupBy("doc_id", "container").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("n"))
    return per.groupBy("doc_id").agg(
        F.sum("n").alias("n_pieces"), F.sum("tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_containers"),
        F.greatest(F.lit(1), F.ceil(F.sum("tokens") / usable)).cast("bigint").alias("least_containers"), F.max("tokens").alias("fullest"),
    )
