"""Time the headline queries and print one JSON line.

Set-up, outside the timing: the raw trips derived from ``lineitem`` are written once as CSV and
Parquet, the clean trips and features as Parquet. Each query then runs once to warm up and three
times for the median; model fits run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from tripgrid.operators import aggregates, analysis, features, ml, quality, state
from tripgrid.operators.cleaning import clean_trips
from tripgrid.session import build_session, release_scratch, scratch_dir
from tripgrid.sources import files, fixtures, sinks
from tripgrid.streaming import cell_state, enrich, events, queries, windows

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 3


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "tripgrid-bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": str(CPUS),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, "bench")

    raw = fixtures.raw_trips(spark, SF_DIR).repartition(CPUS)
    sinks.write_csv(raw, f"{root}/csv")
    sinks.write_parquet(raw, f"{root}/raw")
    sinks.write_parquet(clean_trips(spark.read.parquet(f"{root}/raw")), f"{root}/clean")
    trips = files.read_clean(spark, f"{root}/clean")
    labelled = aggregates.with_labels(aggregates.cell_hour(trips))
    sinks.write_parquet(features.feature_table(labelled), f"{root}/features")
    sinks.write_parquet(labelled, f"{root}/cells")
    cells = spark.read.parquet(f"{root}/cells")
    table, _ = files.read_features(spark, f"{root}/features")
    train, test = features.temporal_split(table)
    raw_rows, clean_rows, feature_rows = (
        spark.read.parquet(f"{root}/{n}").count() for n in ("raw", "clean", "features")
    )

    def stream_windows() -> None:
        folder = scratch_dir(spark, "bench-stream")
        source = queries.file_source(spark, f"{root}/clean", trips.schema)
        gps = events.with_event_time(events.gps_events(source))
        queries.await_all([queries.start(
            windows.window_aggregates(gps), queries.parquet(f"{folder}/data"),
            f"{folder}/checkpoint", every=None,
        )])

    def keyed_state_stream() -> None:
        folder = scratch_dir(spark, "bench-state")
        source = queries.file_source(spark, f"{root}/clean", trips.schema)
        gps = events.with_event_time(events.gps_events(source))
        with cell_state.keyed_state(spark):
            queries.await_all([queries.start(
                cell_state.cell_state_stream(gps), queries.Sink("noop"), f"{folder}/checkpoint", "update", None,
            )])

    def six_analyses() -> None:
        for report in (
            analysis.speed_by_hour, analysis.busiest_cells, analysis.zone_comparison,
            analysis.rush_hotspots, analysis.speed_histogram, analysis.weekday_profile,
        ):
            report(trips).collect()

    gps = events.with_event_time(events.gps_events(trips))
    speed_ok = (F.col("speed_mph") > 0) & (F.col("speed_mph") < 60)
    timed = {
        "clean_csv_to_parquet": (raw_rows, lambda: sinks.write_parquet(
            clean_trips(files.read_raw_csv(spark, f"{root}/csv")), f"{root}/out-clean")),
        "clean_trips": (raw_rows, lambda: drain(
            clean_trips(spark.read.parquet(f"{root}/raw")))),
        "row_funnel": (raw_rows, lambda: quality.row_funnel(
            spark.read.parquet(f"{root}/raw")).collect()),
        "cell_hour": (clean_rows, lambda: drain(labelled)),
        "feature_table_to_parquet": (clean_rows, lambda: sinks.write_parquet(
            features.feature_table(labelled), f"{root}/out-features")),
        "six_analyses": (6 * clean_rows, six_analyses),
        "robust_statistics": (clean_rows, lambda: analysis.robust_statistics(
            trips, "speed_mph", speed_ok).collect()),
        "zone_percentiles": (clean_rows, lambda: analysis.zone_speed_percentiles(trips).collect()),
        "traffic_state": (feature_rows, lambda: state.hotspots(
            state.traffic_state(table), 50).collect()),
        "minute_windows": (clean_rows, lambda: drain(windows.window_aggregates(gps))),
        "minute_windows_stream": (clean_rows, stream_windows),
        "keyed_state_stream": (clean_rows, keyed_state_stream),
        "events_as_of": (clean_rows, lambda: drain(enrich.enrich_as_of(gps, cells))),
    }
    results, rates = {}, {}
    for name, (rows, run) in timed.items():
        run()
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        results[name] = round(statistics.median(seconds), 3)
        rates[name] = int(rows / results[name])
    for kind in ("lr", "rf"):
        fitted = ml.fit(kind, train)
        start = time.perf_counter()
        accuracy = ml.weighted_metrics(ml.outcome_counts(fitted.model.transform(test))).first()[0]
        results[f"fit_{kind}"] = fitted.seconds
        results[f"evaluate_{kind}"] = round(time.perf_counter() - start, 3)
        rates[f"accuracy_{kind}"] = round(accuracy, 4)
    release_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(results.values()), 3),
        "unit": "sec", "queries": results, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "rows_per_second": rates, "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()
