"""State inside streams: logs under a manifest, keyed state, late rows, hot keys."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tests.conftest import SMALL
from tripgrid.operators import history
from tripgrid.operators.state import latest_per_key
from tripgrid.plans import streaming_queries, views
from tripgrid.streaming import cell_state, enrich, late, queries, state_log, windows

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
EVENTS = "event_ts timestamp, cell_id string, cell_lat int, cell_lon int, speed double"


def events_of(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), c, 1, 2, v) for c, s, v in rows], EVENTS
    ).coalesce(1)


def newest_log(spark, path, every=3):
    return state_log.StateLog(spark, str(path), state_log.newest_rows("k", "t"), every)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, t int, v int")


def held(log):
    return sorted(map(tuple, log.read().collect()))


def test_log_keeps_the_newest_row_and_skips_replays(spark, tmp_path):
    log = newest_log(spark, tmp_path / "log")
    first, second = batch(spark, ("a", 1, 1), ("b", 1, 2)), batch(spark, ("a", 5, 9), ("a", 3, 7))
    for rows, epoch in ((first, 0), (second, 1), (second, 1), (first, 0)):
        log.append(rows, "run", epoch)
    assert held(log) == [("a", 5, 9), ("b", 1, 2)]
    # of equal times the row written last wins, merged or not
    log.append(batch(spark, ("a", 5, 1)), "other", 0)
    assert held(log) == [("a", 5, 1), ("b", 1, 2)]
    log.compact(everything=True)
    assert held(log) == [("a", 5, 1), ("b", 1, 2)] and len(log.current()[1]["entries"]) == 1
    log.append(batch(spark, ("b", 1, 0)), "other", 1)
    assert held(log) == [("a", 5, 1), ("b", 1, 0)]


def test_log_stays_short(spark, tmp_path):
    """Folders to read grow with the logarithm of the batches, rows are those of a dictionary."""
    log, rng, expected = newest_log(spark, tmp_path / "log"), random.Random(1), {}
    for epoch in range(30):
        rows = [(rng.choice("abcdef"), epoch, rng.randrange(9)) for _ in range(1)]
        log.append(batch(spark, *rows), "run", epoch)
        expected |= {k: (k, t, v) for k, t, v in rows}
        assert len(log.current()[1]["entries"]) <= 2 * 4
    assert held(log) == sorted(expected.values())
    assert log.vacuum(keep=1, older_than=-1) > 20
    assert held(log) == sorted(expected.values())


def test_merging_beside_a_writer(spark, tmp_path):
    """A batch that arrives while folders are merged stays, and a second merge of them is given up."""
    log, other = newest_log(spark, tmp_path / "log", 9), newest_log(spark, tmp_path / "log", 9)
    for epoch in range(3):
        log.append(batch(spark, ("a", epoch, epoch)), "run", epoch)
    merge = log.merge

    def meanwhile(rows):
        log.merge = merge
        other.append(batch(spark, ("b", 1, 1)), "other", 0)
        return merge(rows)

    log.merge = meanwhile
    log.compact(everything=True)
    assert held(log) == [("a", 2, 2), ("b", 1, 1)]

    def twice(rows):
        log.merge = merge
        other.compact(everything=True)
        return merge(rows)

    log.append(batch(spark, ("c", 1, 1)), "run", 3)
    log.merge = twice
    log.compact(everything=True)
    assert held(log) == [("a", 2, 2), ("b", 1, 1), ("c", 1, 1)]


def test_a_manifest_is_written_once(spark, tmp_path):
    manifests = state_log.Manifests(spark, str(tmp_path / "m"))
    assert manifests.write(1, {"n": 1}) and not manifests.write(1, {"n": 2})
    assert manifests.read(1) == {"n": 1} and manifests.versions() == [1]
    assert json.loads(next(p for p in (tmp_path / "m").iterdir() if p.suffix == ".json" and p.name[0] != ".").read_text()) == {"n": 1}


def run_keyed(spark, tmp_path, every=None, seconds=60, **options):
    out = []
    stream = queries.file_source(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    with cell_state.keyed_state(spark):
        running = queries.to_batches(
            cell_state.cell_state_stream(stream, **options), lambda b, e: out.extend(b.collect()),
            str(tmp_path / "chk"), mode="update", every=every,
        )
        queries.await_all([running], seconds)
    return out


def test_keyed_state_survives_a_restart(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randrange(600), round(rng.uniform(1, 60), 2)) for _ in range(200)]
    for part in (rows[:80], rows[80:81], rows[81:]):
        events_of(spark, part).write.mode("append").parquet(str(tmp_path / "in"))
        run_keyed(spark, tmp_path)
    every = windows.window_aggregates(events_of(spark, rows))
    newest = every.groupBy("cell_id").agg(F.max("window_end").alias("window_end"))
    wanted = every.join(newest, ["cell_id", "window_end"])
    both = [df.select(sorted(wanted.columns)) for df in (cell_state.read_cell_state(spark, str(tmp_path / "chk")), wanted)]
    assert sorted(both[0].collect()) == sorted(both[1].collect())


def test_keyed_state_forgets_silent_cells(spark, tmp_path):
    events_of(spark, [("a", 0, 10.0), ("b", 0, 20.0)]).write.parquet(str(tmp_path / "in"))
    first = run_keyed(spark, tmp_path, "500 milliseconds", 15, idle_seconds=2.0)
    assert [(r["cell_id"], r["expired"]) for r in sorted(first)] == [("a", False), ("a", True), ("b", False), ("b", True)]
    assert cell_state.read_cell_state(spark, str(tmp_path / "chk")).count() == 0


def test_rows_are_summed_before_they_are_dealt(spark):
    rows = events_of(spark, [("a", k % 50, 10.0) for k in range(1000)])
    partial = cell_state.partial_windows(rows).collect()
    assert [(r["trip_count"], r["speed_units"]) for r in partial] == [(1000, 1_000_000)]


def test_a_task_passes_on_one_row_per_cell(spark):
    """Windows older than a cell's newest never leave the task that reads them, however many batches it reads."""
    rows = events_of(spark, [("ab"[k % 2], k * 7919 % 30_000, 10.0 + k % 3) for k in range(30_000)])
    partial = cell_state.partial_windows(rows)
    assert sorted(r["cell_id"] for r in partial.collect()) == ["a", "b"]
    every = windows.window_aggregates(rows)
    wanted = latest_per_key(every, "cell_id", "window_end")
    found = cell_state.as_windows(partial).select(wanted.columns)
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_log_adds_up_equal_windows_of_its_batches(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.randrange(400), round(rng.uniform(1, 60), 2)) for _ in range(300)]
    log = state_log.StateLog(spark, str(tmp_path / "log"), cell_state.newest_sums, every=2)
    for epoch in range(5):
        for _ in range(2):  # the second is a replay
            log.append(cell_state.partial_windows(events_of(spark, rows[epoch * 60 : epoch * 60 + 60])), "run", epoch)
    wanted = latest_per_key(windows.window_aggregates(events_of(spark, rows)), "cell_id", "window_end")
    found = cell_state.as_windows(log.read()).select(wanted.columns)
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_log_query_holds_no_window_open(spark):
    """Five batches, and no state that grows with the windows seen."""

    class Watch(StreamingQueryListener):
        def __init__(self):
            self.batches, self.held = set(), 0

        def onQueryStarted(self, event): ...
        def onQueryIdle(self, event): ...
        def onQueryTerminated(self, event): ...

        def onQueryProgress(self, event):
            if event.progress.numInputRows:
                self.batches.add(event.progress.batchId)
            self.held += len(event.progress.stateOperators)

    watch = Watch()
    spark.streams.addListener(watch)
    cells = streaming_queries.r09_log(spark, SMALL).count()
    deadline = time.monotonic() + 10
    while len(watch.batches) < 5 and time.monotonic() < deadline:
        time.sleep(0.1)
    spark.streams.removeListener(watch)
    assert cells > 0 and len(watch.batches) == 5 and watch.held == 0


def test_late_rows_are_kept_apart(spark, tmp_path):
    found = late.LateKeepingWindows(spark, str(tmp_path), ("cell_id",), every=2)
    handle = found.handle("run")
    batches = [[("a", 0, 10.0), ("a", 300, 20.0)], [("a", 30, 5.0), ("a", 170, 7.0), ("b", 185, 8.0)], [], [("b", 1000, 1.0)], [("b", 185, 2.0)]]
    for epoch, rows in enumerate(batches):
        handle(events_of(spark, rows), epoch)
        handle(events_of(spark, rows), epoch)  # a replay
    late_rows = [((r["event_ts"] - T0).seconds, r["speed"]) for r in found.late_rows().collect()]
    assert sorted(late_rows) == [(30, 5.0), (170, 7.0), (185, 2.0)]
    open_too = {(r["cell_id"], (r["window_end"] - T0).seconds): r["trip_count"] for r in found.windows(False).collect()}
    assert open_too == {("a", 60): 1, ("a", 360): 1, ("b", 240): 1, ("b", 1020): 1}
    assert {(r["window_end"] - T0).seconds for r in found.windows().collect()} == {60, 240, 360}


def test_hot_keys_are_dealt_over_tasks(spark, tmp_path):
    """No file holds more than about the stated number of rows, in the first batch and later."""
    handle = queries.spread_handler(str(tmp_path), ("k",), rows_per_file=100)
    for epoch in range(2):
        df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("k"), "id")
        handle(df.repartition(4), epoch)
    files = spark.read.parquet(str(tmp_path)).withColumn("f", F.input_file_name()).groupBy("k", "f").count()
    assert files.agg(F.max("count")).first()[0] <= 100 and files.agg(F.sum("count")).first()[0] == 6000
    assert files.filter("k = 'hot'").count() >= 20 and files.filter("k <> 'hot'").count() == 80


def test_small_files_take_no_task_each(spark, tmp_path):
    """Two hundred files of a key are the work of one task, or of as many as its rows fill."""
    rows = spark.range(2000).select(F.lit("hot").alias("k"), "id").repartition(4)
    for name, options, tasks in (("one", {}, 1), ("four", {"rows_per_task": 500}, 4)):
        handle = queries.spread_handler(str(tmp_path / name), ("k",), rows_per_file=10, **options)
        for epoch in range(2):
            handle(rows, epoch)
            stored = spark.read.parquet(f"{tmp_path}/{name}").filter(F.col("epoch") == epoch).withColumn("f", F.input_file_name())
            files = [(r["f"].split("/part-")[1][:5], r["count"]) for r in stored.groupBy("f").count().collect()]
            assert sum(n for _, n in files) == 2000 and max(n for _, n in files) == 10
            assert 1 <= len({task for task, _ in files}) <= tasks


def test_months_are_replaced_one_by_one(spark, tmp_path):
    cells = views.labelled(spark, SMALL)
    path = str(tmp_path / "months")
    for month in (3, 1, 2, 1):
        history.add_months(cells.filter(F.col("month") == month), path)
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(history.snapshot(spark, path)) == rows(enrich.history_snapshot(cells))


def test_history_of_a_moment_is_that_of_the_rows_before_it(spark):
    rng = random.Random(3)
    cells = [(1, c, T0 + dt.timedelta(hours=h), (12 + h) % 24, rng.randrange(1, 9), round(rng.uniform(1, 60), 2), rng.randrange(3))
             for c in range(3) for h in sorted(rng.sample(range(120), 60))]
    table = spark.createDataFrame(cells, "cell_lat int, cell_lon int, hour_bucket timestamp, hour int, trip_count long, avg_speed double, congestion_label int")
    asked = [(1, c, T0 + dt.timedelta(hours=h)) for c in range(4) for h in range(0, 130, 7)]
    got = {(r["cell_lon"], r["at"]): r for r in enrich.history_as_of(table, spark.createDataFrame(asked, "cell_lat int, cell_lon int, at timestamp")).collect()}
    assert len(got) == len(asked)
    for _, c, at in asked:
        known = [x for x in cells if x[1] == c and x[2] < at]
        same = [x for x in known if x[3] == at.hour]
        row = got[c, at]
        assert row["prev_trip_count"] == (known[-1][4] if known else None)
        assert row["prev_2h_avg_speed"] == (known[-2][5] if len(known) > 1 else None)
        assert row["historical_avg_trips"] == (sum(x[4] for x in same) / len(same) if same else None)
        assert row["historical_avg_speed"] == (pytest.approx(sum(x[5] for x in same) / len(same)) if same else None)
