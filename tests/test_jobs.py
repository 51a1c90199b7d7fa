"""The batch jobs from raw CSV to a stored model."""

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripgrid.operators import ml
from tripgrid.plans import jobs, views
from tripgrid.schemas import GPS_EVENT
from tripgrid.sources import fixtures, sinks
from tripgrid.streaming import cell_state, enrich, events, queries, state_log, windows


def test_jobs_from_csv_to_model(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    sinks.write_csv(fixtures.raw_trips(spark, SMALL), path("raw"))
    funnel = jobs.run_cleaning(spark, path("raw"), path("clean"))
    assert [r["rows"] for r in funnel.collect()][-1] == 4979
    assert spark.read.parquet(path("clean")).count() == 4979
    jobs.run_features(spark, path("clean"), path("features"))
    table = spark.read.parquet(path("features"))
    assert len(table.columns) == 23 and table.count() == 4648 - 120
    comparison = jobs.run_training(
        spark, path("features"), path("model"), ("rf", "lr"), rf={"numTrees": 5, "maxDepth": 4},
        lr={"maxIter": 5},
    )
    assert comparison.filter("best").count() == 1
    best = comparison.filter("best").first()["model"]
    assert ml.load(path("model")).stages and best in ("rf", "lr")
    assert sinks.read_json_record(spark, path("model/info"))["model"] == best


def test_snapshot_job_adds_months_and_serves_the_stream(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    trips = views.clean(spark, SMALL)
    for month in (1, 2, 3, 2):
        sinks.write_parquet(trips.filter(F.col("month") == month), path("month"))
        jobs.run_snapshot(spark, path("month"), path("snapshot"), path("months"))
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(spark.read.parquet(path("snapshot"))) == rows(enrich.history_snapshot(views.labelled(spark, SMALL)))


def test_stream_job_keeps_its_state_compact(spark, tmp_path):
    """State of the log and of the query's own store after the same events, restarted once."""
    path = lambda name: str(tmp_path / name)
    gps = events.gps_events(views.clean(spark, SMALL)).orderBy("timestamp")
    gps.repartitionByRange(3, "timestamp").write.json(path("in"))
    for _ in range(2):
        source = events.with_event_time(queries.file_source(spark, path("in"), GPS_EVENT, "json", files_per_batch=1))
        jobs.run_stream(spark, source, path("out"), sinks_=("state", "keyed"), every={"state": None, "keyed": None})
    log = state_log.StateLog(spark, path("out/state"), state_log.newest_rows("cell_id", "window_end")).read()
    keyed = cell_state.read_cell_state(spark, path("out/checkpoints/main/keyed"))
    every = windows.window_aggregates(events.with_event_time(events.gps_events(views.clean(spark, SMALL))))
    newest = every.groupBy("cell_id").agg(F.max("window_end").alias("window_end"))
    expected = every.join(newest, ["cell_id", "window_end"])
    rows = lambda df: sorted(map(str, df.select(sorted(expected.columns)).collect()))
    assert rows(log) == rows(keyed) == rows(expected)
