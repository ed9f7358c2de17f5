"""Incremental and stateful processing (ST1-ST6, W8), and event-time windows as an extension."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    """ST1: a folder whose new files are read once each."""
    r = spark.readStream.format(kind).schema(schema)
    return (r.option("maxFilesPerTrigger", per_trigger) if per_trigger else r).load(folder)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """ST1, ST2: whatever has arrived since the last run, batch by batch; the checkpoint folder holds the cursor."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def unprocessed(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """ST3: rows whose key and content signature were not processed yet."""
    return rows.join(done, keys, "left_anti")


def until_complete(step: Callable[[int], int], remaining: Callable[[], int], most: int) -> tuple[int, str]:
    """ST4: passes until nothing remains; ends early after one without progress. Gives passes and ``complete``, ``stalled`` or ``limit``."""
    for n in range(most):
        before = remaining()
        if before == 0:
            return n, "complete"
        step(n)
        if remaining() >= before:
            return n + 1, "stalled"
    return most, "complete" if remaining() == 0 else "limit"


def retried(action: Callable[[], object], attempts: int = 3, wait: float = 0.1, passing: type[Exception] | tuple[type[Exception], ...] = Exception, sleep: Callable[[float], None] = time.sleep) -> object:
    """ST7: what ``action`` gives; after a ``passing`` error it is tried again, each time after a longer wait, and the last error is raised. For calls outside of Spark, which retries its own tasks."""
    for n in range(1, attempts + 1):
        try:
            return action()
        except passing:
            if n == attempts:
                raise
            sleep(wait * n)
    raise ValueError("at least one attempt")


def window_counts(events: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """With ``in_window``: how many of the key's events lie in the ``seconds`` up to each, itself included."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(at).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("in_window", F.count(F.lit(1)).over(w))


def rate_states(events: DataFrame, key: str, at: str, refused: Column) -> DataFrame:
    """ST5: with ``streak`` (refusals in a row up to each event) and ``wait_seconds`` (the cooldown it calls for).

    A streak is the row number since the last success, so windows do, no state machine runs.
    """
    w = Window.partitionBy(key).orderBy(at)
    run = F.sum(F.when(refused, 0).otherwise(1)).over(w)
    e = events.withColumn("_refused", refused.cast("int")).withColumn("_run", run)
    e = e.withColumn("streak", F.sum("_refused").over(Window.partitionBy(key, "_run").orderBy(at)))
    return e.withColumn("wait_seconds", F.when(F.col("streak") == 0, 0.0).otherwise(F.least(F.lit(120.0), 15.0 * F.pow(F.lit(2.0), F.col("streak") - 1)))).drop("_refused", "_run")


RATE = "at double, refused boolean, sent double, wait double, multiplier double, streak int, successes int"


def rate_waits(requests: DataFrame, key: str, per_minute: int, step: float = 0.25, most: float = 4.0, recovery: int = 10, base: float = 15.0, longest: float = 120.0) -> DataFrame:
    """ST5: when each request of a key may be sent: ``key`` and the columns of ``RATE``.

    ``requests``: ``key, at`` (seconds), ``refused``. A request waits for the
    cooldown after refusals (doubling with their streak), for room in the last
    60 seconds, and for the spacing, which a refusal widens by ``step`` up to
    ``most`` times and ``recovery`` successes in a row narrow again. Each depends
    on the one before, so a key is one state machine; its requests meet in one
    task, as they must to be spaced.
    """

    def run(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        spacing, sent, free, last, streak, good, times = 60.0 / per_minute, 0.0, 0.0, None, 0, 0, 1.0
        window: deque[float] = deque()
        rows = []
        for at, refused in pdf.sort_values(["at", "refused"])[["at", "refused"]].itertuples(index=False):
            sent = max(at, sent, free)
            while window and sent - window[0] >= 60.0:
                window.popleft()
            if len(window) >= per_minute:
                sent = max(sent, window[0] + 60.0)
            if last is not None:
                sent = max(sent, last + spacing * times)
            window.append(sent)
            last = sent
            if refused:
                good, streak, times = 0, streak + 1, min(most, times + step)
                free = max(free, sent + min(longest, base * 2 ** (streak - 1)))
            else:
                streak, good = 0, good + 1
                if good >= recovery and times > 1.0:
                    times, good = max(1.0, times - step), 0
            rows.append((name[0], at, bool(refused), sent, sent - at, times, streak, good))
        return pd.DataFrame(rows, columns=[key, "at", "refused", "sent", "wait", "multiplier", "streak", "successes"])

    kind = dict(requests.dtypes)[key]
    return requests.select(key, F.col("at").cast("double"), F.col("refused").cast("boolean")).groupBy(key).applyInPandas(run, f"`{key}` {kind}, {RATE}")


def tumbling(events: DataFrame, at: str, width: str, late: str | None = None) -> DataFrame:
    """Extension: counts and sums per time window; on a stream with a watermark for late rows."""
    e = events.withWatermark(at, late) if late else events
    return e.groupBy(F.window(at, width)).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "n", "total")


def sessions(events: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """Extension: sessions of a key, ended by a gap."""
    return events.groupBy(key, F.session_window(at, gap)).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")
