"""Totals and silent periods by state and timers, and totals gathered in passing."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom.operators import distributions as D
from threadloom.sources.readers import stream_files
from threadloom.streaming import rates, tracks

POSTS = "id long, created_at timestamp_ntz, query string"
T0 = dt.datetime(2024, 1, 1)


def minute(n):
    return T0 + dt.timedelta(minutes=n)


# Nothing at all from minute 40 to 79; the last post closes what ends by minute 110.
DATA = [(1, minute(1), "@a"), (2, minute(2), "@a"), (3, minute(12), "@b"), (4, minute(35), "@a"), (5, minute(85), "@b"), (6, minute(120), "@x"), (7, minute(121), "@a")]


def landed(spark, folder, parts):
    for rows in parts:
        spark.createDataFrame(rows, POSTS).coalesce(1).write.mode("append").parquet(str(folder))
    return stream_files(spark, str(folder), spark.createDataFrame([], POSTS).schema, files_per_batch=1)


def test_tracks_silent_from_the_start_and_gaps(spark, tmp_path):
    names = ["@a", "@b", "@quiet"]
    before = spark.conf.get(tracks.PROVIDER)
    for parts in ([DATA[:3], DATA[3:5]], [DATA[5:]]):  # the second run goes on from the state of the first
        rows = tracks.tracked(landed(spark, tmp_path / "in", parts), names)
        tracks.start_tracked(rows, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert spark.conf.get(tracks.PROVIDER) == before
    got = tracks.read_tracked(spark, str(tmp_path / "out"))
    whole = rates.flat(rates.rates(spark.createDataFrame(DATA, POSTS)))
    expected = rates.report(rates.with_silence(whole, names)).where(F.col("period_end") <= F.lit(minute(111)).cast("timestamp_ntz"))
    pick = lambda df: sorted(tuple(r) for r in df.select("query", "period_start", "period_end", "n", "total").collect())
    assert pick(got) == pick(expected) and got.count() == 33
    assert got.where("query = '@quiet' and n = 0").count() == 11


class Handle:
    """What a processor asks of Spark, in memory."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):
        return self.mark


def test_timer_gives_out_silence_in_bounded_frames():
    handle, clock = Handle(), tracks.TrackClock(10)
    clock.init(handle)
    frame = pd.DataFrame({"start_ms": [20, 0, 0], "n": [2, 3, 0]})
    rows = pd.concat(clock.handleInputRows(("@a",), iter([frame]), None))
    assert list(zip(rows["n"], rows["total"])) == [(3, 3), (0, 3), (2, 5)] and handle.timers == {40}
    handle.timers.clear()
    handle.mark = 30 + 10 * (tracks.TrackClock.ROWS + 5) + 7
    frames = list(clock.handleExpiredTimer(("@a",), handle, None))
    assert [len(f) for f in frames] == [tracks.TrackClock.ROWS, 5] and set(pd.concat(frames)["total"]) == {5}
    assert handle.value == (handle.mark - 7, 5) and handle.timers == {handle.mark + 3}
    late = pd.DataFrame({"start_ms": [30], "n": [0]})
    assert list(clock.handleInputRows(("@a",), iter([late]), None)) == []


def test_trigger_totals_are_period_totals(spark, tmp_path):
    """A file per period: what a trigger counts in passing is what the batch counts per period."""
    names = ["@a", "@b", "@quiet"]
    totals = tracks.TriggerTotals(names)
    spark.streams.addListener(totals)
    try:
        for rows in (DATA[:2], DATA[2:3], DATA[3:4]):
            stream = tracks.observed(landed(spark, tmp_path / "in", [rows]), names)
            plan = stream._jdf.queryExecution().analyzed().toString()
            assert "Aggregate" not in plan and "CollectMetrics" in plan
            writer = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log"))
            query = writer.trigger(availableNow=True).start()
            query.awaitTermination()
            totals.wait(query)
    finally:
        spark.streams.removeListener(totals)
    posts = spark.createDataFrame(DATA[:4], POSTS)
    expected = sorted((r.period_start, r.query or "", r.n) for r in rates.period_totals(posts).collect())
    starts = [minute(0), minute(10), minute(30)]
    got = totals.rows()
    assert sorted((starts[b], q or "", n) for b, q, n, _ in got if n) == expected
    assert [total for _, q, _, total in got if q is None] == [2, 3, 4] and len(got) == 12


def test_a_trigger_that_runs_again_counts_once():
    class Event:
        class progress:
            id, batchId, observedMetrics = "s", 0, {tracks.OBSERVED: {"all": 5, "track_0": 2}}

    totals = tracks.TriggerTotals(["@a"], keep=1)
    totals.onQueryProgress(Event)
    totals.onQueryProgress(Event)
    Event.progress.batchId = 1
    totals.onQueryProgress(Event)
    assert totals.rows() == [(1, None, 5, 10), (1, "@a", 2, 4)]


def test_a_wrong_time_is_told_or_left_out(spark):
    posts = spark.createDataFrame([*DATA, (9, dt.datetime(9998, 1, 1), "@a")], POSTS)
    counted = rates.flat(rates.rates(posts))
    for work in (rates.stalls, rates.with_silence):
        with pytest.raises(Exception, match="more than 1000000 steps"):
            work(counted, tracks=["@a"]).collect()
        assert work(counted, tracks=["@a"], within=(minute(0), minute(200))).count() < 20


def test_a_wrong_date_is_told_or_left_out(spark):
    rows = spark.createDataFrame([("a", dt.datetime(2020, 1, d)) for d in (1, 3, 9)] + [("a", dt.datetime(9998, 1, 1))], "user string, created_at timestamp_ntz")
    with pytest.raises(Exception, match="more than 36525 steps"):
        D.date_density(rows).collect()
    assert D.date_density(rows, within=(dt.date(2000, 1, 1), dt.date(2030, 1, 1))).count() == 9
