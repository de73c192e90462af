"""Live totals: by a state and a timer per track, or as metrics that a stream gathers while it does other work."""

from __future__ import annotations

import itertools
import threading
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from threadloom.streaming.rates import REPORT_PERIOD, live_rates

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

TRACKED = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("period_start", T.TimestampType()),
        T.StructField("period_end", T.TimestampType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)


class TrackClock(StatefulProcessor):
    """One row per track and period, 0 where nothing came. Kept per track: the next period's start and the total.

    A period comes with its count, and every period before it that brought nothing is given out then; the timer
    at the end of the next period gives it out when the watermark passes and nothing came at all.
    """

    ROWS = 10_000

    def __init__(self, every_ms: int):
        self.every = every_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "next long, total long")

    def _frames(self, track, periods: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        """(start, n, total) as frames of at most ``ROWS`` rows."""
        while part := list(itertools.islice(periods, self.ROWS)):
            start, n, total = zip(*part)
            starts = pd.to_datetime(pd.Series(start, dtype="int64"), unit="ms")
            ends = starts + pd.Timedelta(milliseconds=self.every)
            yield pd.DataFrame({"query": track, "period_start": starts, "period_end": ends, "n": n, "total": total})

    def _silent(self, start: int, until: int, total: int) -> Iterator[tuple]:
        return ((at, 0, total) for at in range(start, until, self.every))

    def _periods(self, counts: dict[int, int], next_: int | None, total: int) -> Iterator[tuple]:
        """Every period from the next one to the last that came."""
        for start in sorted(counts):
            if next_ is not None:
                yield from self._silent(next_, start, total)
            total += counts[start]
            next_ = start + self.every
            yield start, counts[start], total

    def _keep(self, old: int | None, next_: int, total: int) -> None:
        if old is not None:
            self.handle.deleteTimer(old + self.every)
        self.handle.registerTimer(next_ + self.every)
        self.kept.update((next_, total))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for frame in rows:
            for start, n in zip(frame["start_ms"], frame["n"]):
                counts[int(start)] = counts.get(int(start), 0) + int(n)
        old, total = self.kept.get() if self.kept.exists() else (None, 0)
        # A period the timer has given out as silent had no post: only its beat can come after that.
        counts = {start: n for start, n in counts.items() if old is None or start >= old}
        if counts:
            yield from self._frames(key[0], self._periods(counts, old, total))
            self._keep(old, max(counts) + self.every, total + sum(counts.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        next_, total = self.kept.get()
        until = next_ + (timerValues.getCurrentWatermarkInMs() - next_) // self.every * self.every
        if until > next_:
            yield from self._frames(key[0], self._silent(next_, until, total))
            self.kept.update((until, total))
            self.handle.registerTimer(until + self.every)

    def close(self) -> None:
        pass


def milliseconds(every: str) -> int:
    """Length of a period such as ``600 seconds``."""
    return int(pd.Timedelta(every).value // 1_000_000)


def tracked(stream: DataFrame, tracks: Sequence[str] | None = None, every: str = REPORT_PERIOD, delay: str = "10 minutes") -> DataFrame:
    """query, period_start, period_end, n and the total so far of every track in every closed period.

    Posts are counted per period and track first, in the map tasks, so a track with a third of all posts is one
    row a period for its state. Each closed period beats for all ``tracks``, so one that never has a post is
    watched from the first period on, too; posts of other tracks are left out. Without a list a track is watched from its first post on.
    """
    if tracks is not None:
        stream = stream.where(F.col("query").isin(list(tracks)))
    counted = live_rates(stream, every, delay).withColumn("start_ms", F.unix_millis(F.col("period_start").cast("timestamp")))
    named = [F.struct("query", F.col("n").cast("long").alias("n"))]
    named += [F.struct(F.lit(t).alias("query"), F.lit(0).cast("long").alias("n")) for t in dict.fromkeys(tracks or [])]
    beats = counted.select("start_ms", F.explode(F.array(*named)).alias("b")).select("b.query", "b.n", "start_ms")
    return beats.groupBy("query").transformWithStateInPandas(TrackClock(milliseconds(every)), TRACKED, "Append", "EventTime")


def start_tracked(rows: DataFrame, folder: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Write the rows of :func:`tracked` to ``folder``: every ``period``, or over what is there and then stop.

    States of this kind are kept in RocksDB; the session's own setting is put back once the query has taken it.
    """
    spark = rows.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        writer = rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)).start()
    finally:
        spark.conf.set(PROVIDER, before)


def read_tracked(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.schema(TRACKED).parquet(folder)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("period_start", "period_end")})


OBSERVED = "posts_by_track"


def observed(stream: DataFrame, tracks: Sequence[str]) -> DataFrame:
    """The stream itself; each trigger's posts, of all and of every track, are counted as they pass: no second aggregation, no shuffle."""
    per_track = [F.count_if(F.col("query") == t).alias(f"track_{i}") for i, t in enumerate(tracks)]
    return stream.observe(OBSERVED, F.count(F.lit(1)).alias("all"), *per_track)


class TriggerTotals(StreamingQueryListener):
    """Totals of :func:`observed` streams: per trigger and track the new posts and all so far; None stands for all tracks.

    Only the running totals and the last ``keep`` triggers are held. A trigger that runs again after a restart is counted once.
    """

    def __init__(self, tracks: Sequence[str], keep: int = 1_000):
        self.names = {"all": None, **{f"track_{i}": t for i, t in enumerate(tracks)}}
        self.keep, self.totals, self.triggers, self.done = keep, {t: 0 for t in self.names.values()}, [], {}
        self.lock, self.ended, self.finished = threading.Lock(), threading.Condition(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # Events come in order: after this one, no progress of the query is outstanding.
        with self.ended:
            self.finished.add(str(event.runId))
            self.ended.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all triggers of a query that has ended are counted."""
        with self.ended:
            if not self.ended.wait_for(lambda: str(query.runId) in self.finished, seconds):
                raise TimeoutError(f"no word of the end of {query.runId} in {seconds} seconds")

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OBSERVED)
        if seen is None:
            return
        with self.lock:
            source, batch = str(event.progress.id), event.progress.batchId
            if batch <= self.done.get(source, -1):
                return
            self.done[source] = batch
            counts = {t: seen[name] or 0 for name, t in self.names.items()}
            for t, n in counts.items():
                self.totals[t] += n
            self.triggers = [*self.triggers, (batch, counts, dict(self.totals))][-self.keep :]

    def rows(self) -> list[tuple]:
        """(trigger, query, n, total), a row per track and one without for all."""
        with self.lock:
            return [(batch, t, n, totals[t]) for batch, counts, totals in self.triggers for t, n in counts.items()]
