"""A drained stream gives what the batch gives."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from patronage.plans.queries import REGISTRY
from patronage.sources import mapping
from patronage.streaming import counts, feed, keyed
from tests.conftest import SMALL


def folder():
    return tempfile.mkdtemp(prefix="patronage-test-")


@pytest.fixture(scope="module")
def events(spark, small):
    """The events in several files, so that a drained stream takes several triggers."""
    path = folder() + "/events"
    table = mapping.table(spark, small, "events")
    for day in range(1, 31, 8):  # one after the other: the watermark moves with the files
        part = table.where(f"day(ts) >= {day} AND day(ts) < {day + 8}")
        part.coalesce(1).write.mode("append").parquet(path)
    return path, table


def views(spark, events, streaming):
    path, table = events
    rows = feed.file_rows(spark, path, table.schema, files_per_trigger=1) if streaming else table
    return feed.page_views(feed.decode_events(mapping.click_messages(rows)))


def drained(df):
    """Complete-mode result after all input."""
    path = folder() + "/out"
    feed.write_each(
        df,
        lambda result, _: result.write.mode("overwrite").parquet(path),
        folder(),
        "complete",
        drain=True,
    ).awaitTermination()
    return sorted(map(tuple, df.sparkSession.read.parquet(path).collect()))


@pytest.mark.parametrize(
    "count",
    [
        lambda v: counts.page_counts(v),
        lambda v: counts.page_counts(v, "1 hour"),
        lambda v: counts.visitor_counts(v),
        lambda v: counts.visitor_counts(v, "1 hour", "20 minutes"),
    ],
)
def test_stream_equals_batch(spark, events, count):
    batch = sorted(map(tuple, count(views(spark, events, False)).collect()))
    assert drained(count(views(spark, events, True))) == batch


@pytest.mark.parametrize("slide", [None, "20 minutes"])
def test_distinct_visitors_in_append_mode(spark, events, slide):
    out, late = folder() + "/out", "10 minutes"
    stream = counts.distinct_visitors(views(spark, events, True), "1 hour", slide, late)
    feed.write_files(stream, out, folder(), drain=True).awaitTermination()
    got = sorted(map(tuple, spark.read.schema(stream.schema).parquet(out).collect()))
    batch = sorted(
        map(tuple, counts.distinct_visitors(views(spark, events, False), "1 hour", slide).collect())
    )
    newest = max(r.timestamp for r in views(spark, events, False).collect())
    closed = [r for r in batch if r[1] <= newest - dt.timedelta(minutes=10)]
    open_ = [r for r in batch if r not in closed]
    assert got[: len(closed)] == closed and set(got) - set(closed) <= set(open_)
    assert len(closed) > 500


def test_late_views_are_counted_in_batches(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 10, tzinfo=dt.timezone.utc)
    rows = [("1", "a", "/x", t), ("1", "b", "/x", t - dt.timedelta(hours=5))]
    df = spark.createDataFrame(rows, "site string, visitor string, pageurl string, timestamp timestamp")
    assert counts.page_counts(df, late="1 second").count() == 2


def test_unreadable_messages_are_left_out(spark):
    good = json.dumps({"topic": "publisher", "data": {"idsite": "1", "_id": "0a", "url": "/x"}})
    df = spark.createDataFrame([(good,), ("{",), ("{}",)], "value string").selectExpr(
        "value", "timestamp '2024-01-01 00:00:00' AS timestamp"
    )
    got = feed.page_views(feed.decode_events(df)).collect()
    assert [(r.site, r.visitor, r.pageurl) for r in got] == [("1", "0a", "/x")]


def test_json_messages(spark):
    df = spark.createDataFrame([("/x", 3, 9)], "url string, count bigint, other int")
    assert json.loads(feed.json_messages(df, ["url", "count"]).first().value) == {"url": "/x", "count": 3}


def test_estimates_are_close(spark, events):
    v = views(spark, events, False)
    exact = v.selectExpr("count(DISTINCT pageurl) AS p", "count(DISTINCT visitor) AS n").first()
    got = counts.clickstream_estimates(v.withColumn("site", v.site.substr(1, 0)), "365 days").collect()
    assert abs(sum(r.pages for r in got) - exact.p) <= 0.15 * exact.p
    assert abs(max(r.visitors for r in got) - exact.n) <= 0.15 * exact.n + 1


def test_updates_with_a_watermark_keep_the_newest_count(spark, events):
    count = lambda v: counts.page_counts(v, "1 hour", late="1 day")
    found = count(views(spark, events, True))
    path = folder() + "/updates"
    feed.write_updates(found, path, folder(), drain=True).awaitTermination()
    stored = feed.latest(spark, path, found.schema, ["start", "end", "url"])
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, count(views(spark, events, False)).collect()))
    assert spark.read.parquet(path).select("trigger").distinct().count() > 1


def test_ticks_do_not_change_the_windows(spark, events):
    v = views(spark, events, False)
    direct = v.groupBy(F.window("timestamp", "15 seconds", "2 seconds").alias("w"), "visitor").count()
    want = sorted((r.w.start, r.w.end, r.visitor, r["count"]) for r in direct.collect())
    assert sorted(map(tuple, counts.visitor_counts(v).collect())) == want


def sketched(spark, events, **options):
    v = views(spark, events, False)
    return sorted(map(tuple, counts.clickstream_estimates(v, **options).select("start", "end", "site", "views", "pages", "visitors", "top_pages", "top_visitors").collect()))


@pytest.mark.parametrize(("slide", "tick"), [(None, "1 hour"), ("6 hours", "1 hour"), ("6 hours", "2 hours")])
def test_merged_sketches_equal_counts(spark, events, slide, tick):
    v = views(spark, events, False)
    w = F.window("timestamp", "1 day", slide or "1 day").alias("w")
    rows = v.select(w, "site", "pageurl", "visitor").collect()
    want = {}
    for r in rows:
        want.setdefault((r.w.start, r.w.end, r.site), []).append((r.pageurl, r.visitor))

    def top(values):
        n = {x: values.count(x) for x in set(values)}
        return " ".join(f"{x}:{c}" for c, x in sorted((-c, x) for x, c in n.items())[:5]).replace(":-", ":")

    expected = [(*k, len(x), len({p for p, _ in x}), len({u for _, u in x}), top([p for p, _ in x]), top([u for _, u in x])) for k, x in want.items()]
    assert sketched(spark, events, slide=slide, tick=tick) == sorted(expected)


def test_counts_are_exact_beyond_what_a_sketch_holds(spark):
    """Thirty thousand visitors, of whom one is seen thrice, and a null; a sketch of so many is off."""
    t = "timestamp '2024-01-01 05:00:00' + make_interval(0, 0, 0, 0, id % 20)"
    many = spark.range(30_000).selectExpr("'1' AS site", "concat('v', id) AS visitor", "concat('/', id % 9000) AS pageurl", f"{t} AS timestamp")
    again = spark.range(2).selectExpr("'1' AS site", "'v29999' AS visitor", "CAST(null AS string) AS pageurl", f"{t} AS timestamp")
    got = counts.clickstream_counts(many.unionByName(again), "30 days", tick="1 hour").collect()
    assert [(r.views, r.pages, r.visitors) for r in got] == [(30_002, 9_000, 30_000)]
    assert got[0].top_visitors == "v29999:3 v0:1 v1:1 v10:1 v100:1" and got[0].top_pages == "/0:4 /1:4 /10:4 /100:4 /1000:4"
    assert counts.clickstream_counts(many.limit(0)).isEmpty()
    query = REGISTRY["clickstream_estimates"](spark, SMALL)
    assert "hll" not in query._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_of_batches_merge(spark, events):
    """Sketches made of parts of the views, stored and read again, say what those of all say."""
    v = views(spark, events, False)
    path = folder() + "/sketches"
    for part in range(3):
        counts.click_sketches(v.where(F.pmod(F.xxhash64("visitor", "timestamp"), F.lit(3)) == part)).write.mode("append").parquet(path)
    merged = counts.merge_sketches(spark.read.parquet(path))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, counts.clickstream_estimates(v).collect()))


def test_estimates_of_a_sketch_that_is_too_small_are_seen(spark, events):
    """With fewer items followed than there are, the frequent ones are no longer sure: the comparison can fail."""
    v = views(spark, events, False).withColumn("site", F.lit("x"))
    exact = counts.clickstream_estimates(v, "365 days", tick="1 day").collect()
    small = counts.clickstream_estimates(v, "365 days", tick="1 day", tracked=8).collect()
    assert [r.top_visitors for r in exact] != [r.top_visitors for r in small] and [r.views for r in exact] == [r.views for r in small]


@pytest.mark.parametrize(("window", "slide", "tick"), [("15 seconds", "2 seconds", "1 second"), ("1 hour", "20 minutes", "5 minutes"), ("90 seconds", "1 minute", "30 seconds")])
def test_keyed_state_equals_batch(spark, events, window, slide, tick):
    counted = keyed.visitor_counts(views(spark, events, True), "30 days", window, slide, tick)
    path = folder() + "/keyed"
    feed.write_updates(counted, path, folder(), drain=True).awaitTermination()
    stored = feed.latest(spark, path, counted.schema, ["start", "end", "visitor"])
    batch = counts.visitor_counts(views(spark, events, False), window, slide)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))


class Handle:
    """What a processor sees of its state, for one visitor."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        return self.timers

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class At:
    def __init__(self, seconds):
        self.seconds = seconds

    def getCurrentWatermarkInMs(self):
        return self.seconds * 1000


def test_state_of_a_visitor_expires():
    ring, handle = keyed.Ring(10_000_000, 5_000_000, 1_000_000), Handle()
    ring.init(handle)
    at = [{"at": s * 1_000_000 + 7} for s in (100, 100, 103)]
    out = list(ring.handleInputRows(("v",), iter(at), At(0)))
    assert [(r["start"].timestamp(), r["count"]) for r in out] == [(95.0, 3), (100.0, 3)]
    assert handle.value == ([100_000_000, 103_000_000], [2, 1]) and len(handle.timers) == 1
    list(ring.handleInputRows(("v",), iter([{"at": 109_000_000}]), At(50)))
    assert handle.value[0] == [100_000_000, 103_000_000, 109_000_000] and handle.timers == [111_001]
    list(ring.handleExpiredTimer(("v",), At(112), None))
    assert handle.value == ([103_000_000, 109_000_000], [1, 1]) and handle.timers == [114_001]
    list(ring.handleExpiredTimer(("v",), At(500), None))
    assert handle.value is None and handle.timers == []


def test_stored_ticks_merge_into_the_windows_of_the_table(spark, events):
    ticks = counts.tick_counts(views(spark, events, True), late="30 days")
    path = folder() + "/ticks"
    feed.write_updates(ticks, path, folder(), drain=True).awaitTermination()
    stored = feed.latest(spark, path, ticks.schema, ["timestamp", "visitor"])
    v = views(spark, events, False)
    assert sorted(map(tuple, counts.merge_ticks(stored).collect())) == sorted(map(tuple, counts.visitor_counts(v).collect()))
    # one row of state per visitor and tick, however many windows a view lies in
    assert spark.read.parquet(path).count() <= v.count()


def test_a_visitor_is_new_in_a_window_once(spark, events):
    """Windows of many days: visitors come back to them, in a later batch or in the same one."""
    window, slide = "20 days", "10 days"
    seen = keyed.new_visitors(views(spark, events, True), "30 days", window, slide, "1 hour")
    path = folder() + "/seen"
    feed.write_updates(seen, path, folder(), drain=True).awaitTermination()
    got = sorted(tuple(r)[:3] for r in spark.read.parquet(path).select("start", "end", "visitor").collect())
    batch = counts.visitor_counts(views(spark, events, False), window, slide, tick="hour")
    assert got == sorted(tuple(r)[:3] for r in batch.collect()) and len(set(got)) == len(got)


def test_newest_rows_are_found_without_sorting(spark):
    path = folder() + "/updates"
    rows = [[("a", 1), ("b", 2)], [("b", None)], []]
    for trigger, some in enumerate(rows[:1]):
        spark.createDataFrame(some, "k string, n bigint").write.parquet(f"{path}/trigger={trigger}")
    schema = spark.createDataFrame([], "k string, n bigint").schema
    one = feed.latest(spark, path, schema, ["k"])
    assert sorted(map(tuple, one.collect())) == rows[0] and "Aggregate" not in one._jdf.queryExecution().executedPlan().toString()
    for trigger, some in list(enumerate(rows))[1:]:
        spark.createDataFrame(some, "k string, n bigint").write.parquet(f"{path}/trigger={trigger}")
    both = feed.latest(spark, path, schema, ["k"])
    assert sorted(map(tuple, both.collect())) == [("a", 1), ("b", None)]
    assert "SortAggregate" not in both._jdf.queryExecution().executedPlan().toString()
