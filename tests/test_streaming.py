"""Streams: late rows, replays, sinks and the equality of batch and stream."""

import datetime as dt
import json

import pytest

from tests.conftest import SMALL
from tripgrid.operators.state import latest_per_key
from tripgrid.plans import catalog, views
from tripgrid.schemas import GPS_EVENT
from tripgrid.sources import fixtures
from tripgrid.streaming import events, queries, windows

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = "event_ts timestamp, cell_id string, cell_lat int, cell_lon int, speed double"


def write_files(spark, folder, batches):
    """One file per batch, read in this order."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(
            [(T0 + dt.timedelta(seconds=s), "c", 1, 2, v) for s, v in rows], SCHEMA
        ).coalesce(1)
        df.write.mode("append").parquet(str(folder))
    return str(folder)


def run_windows(spark, tmp_path, batches):
    path = write_files(spark, tmp_path / "in", batches)
    schema = spark.read.parquet(path).schema
    stream = queries.file_source(spark, path, schema, files_per_batch=1)
    query = queries.start(
        windows.window_aggregates(stream), queries.parquet(str(tmp_path / "out")),
        str(tmp_path / "chk"), every=None,
    )
    queries.await_all([query])
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    return query, {(r["window_start"] - T0).total_seconds(): r["trip_count"] for r in rows}


def test_late_rows(spark, tmp_path):
    """A row within two minutes counts, one far behind the watermark is dropped."""
    _, counts = run_windows(spark, tmp_path, [
        [(0, 10.0), (30, 20.0)],
        [(300, 12.0)],
        [(310, 11.0)],
        [(200, 14.0), (5, 40.0)],
        [(3600, 9.0)],
        [(7200, 9.0)],
    ])
    assert counts[0] == 2
    assert counts[180] == 1
    assert counts[300] == 2


def test_progress_summary(spark, tmp_path):
    totals = queries.watch_progress(spark)
    query, _ = run_windows(spark, tmp_path, [[(0, 1.0)], [(600, 1.0)]])
    summary = queries.progress_summary(query, totals)
    spark.streams.removeListener(totals)
    assert summary["active"] and summary["input_rows"] == 2


def test_a_failing_query_stops_the_set(spark, tmp_path):
    """The failure of the second query is seen while the first one still runs."""
    path = write_files(spark, tmp_path / "in", [[(0, 1.0)]])
    stream = queries.file_source(spark, path, spark.read.parquet(path).schema)

    def fail(batch, epoch):
        raise ValueError("broken")

    running = queries.to_batches(stream, lambda b, e: None, str(tmp_path / "c1"), every="1 second")
    failing = queries.to_batches(stream, fail, str(tmp_path / "c2"), every="1 second")
    with pytest.raises(Exception, match="broken"):
        queries.await_all([running, failing], seconds=60)
    assert not running.isActive and not failing.isActive


def test_waiting_ends_at_the_deadline(spark, tmp_path):
    path = write_files(spark, tmp_path / "in", [[(0, 1.0)]])
    stream = queries.file_source(spark, path, spark.read.parquet(path).schema)
    query = queries.to_batches(stream, lambda b, e: None, str(tmp_path / "c"), every="1 second")
    queries.await_all([query], seconds=2)
    assert not query.isActive


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    handle = queries.changelog_handler(path, "k", "t")
    first = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "k string, t int, v int")
    second = spark.createDataFrame([("a", 5, 9), ("a", 3, 7)], "k string, t int, v int")
    for batch, epoch in ((first, 0), (second, 1), (second, 1), (first, 0)):
        handle(batch, epoch)
    read = lambda p: sorted(map(tuple, queries.read_state(spark, p, "k", "t").collect()))
    assert read(path) == [("a", 5, 9), ("b", 1, 2)]
    compact = str(tmp_path / "compact")
    queries.compact_state(spark, path, compact, "k", "t")
    assert read(compact) == read(path)
    queries.changelog_handler(compact, "k", "t")(second.filter("v = 9").replace(9, 1, ["v"]), 0)
    assert read(compact) == [("a", 5, 1), ("b", 1, 2)]


def test_latest_per_key_breaks_ties_by_the_whole_row(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 3)], "k string, t int, v int")
    assert latest_per_key(df, "k", "t").first()["v"] == 3


def test_batch_equals_stream(spark, tmp_path):
    trips = views.clean(spark, SMALL)
    trips.write.parquet(str(tmp_path / "trips"))
    source = queries.file_source(spark, str(tmp_path / "trips"), trips.schema)
    gps = lambda df: events.with_event_time(events.gps_events(df))
    rows = lambda df: sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())
    for name, build in (("windows", windows.window_aggregates), ("live", windows.live_state)):
        out = str(tmp_path / name)

        def handle(batch, epoch, out=out):
            batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

        queries.await_all([queries.to_batches(
            build(gps(source)), handle, str(tmp_path / f"chk-{name}"), mode="complete", every=None
        )])
        stored = spark.read.parquet(out).filter("epoch = 0").drop("epoch")
        assert rows(stored) == rows(build(gps(trips)))


def test_empty_batch_is_not_written(spark, tmp_path):
    handle = queries.scoring_handler(lambda df: df, str(tmp_path / "scored"))
    handle(spark.createDataFrame([], "a int"), 0)
    assert not (tmp_path / "scored").exists()


def test_bad_json_keeps_the_key(spark):
    df = spark.createDataFrame([("k", "{broken")], "key string, value string")
    row = events.parse_messages(df).first()
    assert row["message_key"] == "k" and row["event_id"] is None


def test_messages_carry_all_fields(spark):
    message = events.to_messages(events.gps_events(views.clean(spark, SMALL))).first()
    value = json.loads(message["value"])
    assert set(value) == set(GPS_EVENT.names) and value["cell_id"] == message["key"]


def test_message_text_is_not_made_inside_the_json_reader(spark):
    """Neither query folds the making of its messages into the reader, which interprets its argument."""
    for name in ("r01_parse_messages", "r01_parse_trip_messages"):
        plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        readers = [line for line in plan.splitlines() if "from_json(" in line]
        assert len(readers) == 1 and "StructsToJson" not in readers[0] and "StructsToJson" in plan
    odd = spark.createDataFrame([(b"k", None), (None, b"no json"), (b"k", b'{"speed": 2.5}')], "key binary, value binary")
    rows = [(r["message_key"], r["event_id"], r["speed"]) for r in events.parse_messages(odd).collect()]
    assert rows == [("k", None, None), (None, None, None), ("k", None, 2.5)]


def test_console_sink(spark, tmp_path, capfd):
    schema = fixtures.table(spark, SMALL, "nation").schema
    stream = queries.file_source(spark, f"{SMALL}/nation.parquet*", schema)
    queries.await_all([queries.start(stream, queries.console(rows=3), every=None)])


def test_console_gets_few_rows_of_each_task(spark, tmp_path):
    """The driver gets what is shown and not the batch; the whole batch is read all the same."""
    spark.range(40_000).repartition(4).write.parquet(str(tmp_path / "in"))
    sent = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            sent.add(batch.num_rows)
            yield batch

    class Stream:  # sees the frame that reaches the format
        schema = spark.range(1).schema

        def mapInArrow(self, function, schema):
            self.function = function
            raise StopIteration

    cut = Stream()
    with pytest.raises(StopIteration):
        queries.start(cut, queries.console(rows=3))
    stream = queries.file_source(spark, str(tmp_path / "in"), Stream.schema)
    totals = queries.watch_progress(spark)
    shown = stream.mapInArrow(cut.function, Stream.schema).mapInArrow(counted, Stream.schema)
    running = shown.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start()
    queries.await_all([running])
    assert queries.progress_summary(running, totals)["input_rows"] == 40_000
    spark.streams.removeListener(totals)
    assert 4 <= sent.value <= 4 * 4


def test_event_time_formats(spark):
    df = spark.createDataFrame(
        [("2024-01-01T12:00:00Z",), ("2024-01-01T12:00:00",), ("nonsense",)], "timestamp string"
    )
    assert [r["event_ts"] for r in events.with_event_time(df).collect()] == [T0, T0, None]
