"""The batch steps end to end, from table to table, as functions and as a command.

    python -m tripgrid.plans.jobs clean    --input RAW_CSV --output CLEAN
    python -m tripgrid.plans.jobs features --input CLEAN --output FEATURES
    python -m tripgrid.plans.jobs snapshot --input CLEAN --output SNAPSHOT --history HISTORY
    python -m tripgrid.plans.jobs train    --input FEATURES --output MODEL
    python -m tripgrid.plans.jobs score    --input ROWS --model MODEL --output SCORES
    python -m tripgrid.plans.jobs stream   --input EVENTS --output STREAMS --sinks raw,windows,state

Paths are URIs, so local folders, HDFS and object stores differ in the argument only.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tripgrid import profiles
from tripgrid.operators import aggregates, features, history, ml, quality
from tripgrid.operators.cleaning import from_prepared
from tripgrid.schemas import GPS_EVENT
from tripgrid.session import TARGETS, build_session, release_scratch
from tripgrid.sources import files, sinks
from tripgrid.streaming import cell_state, enrich, events, queries, state_log, windows


def run_cleaning(
    spark: SparkSession,
    source: str,
    target: str,
    profile: profiles.CleanProfile = profiles.STANDARD,
    name_filter: str | None = None,
) -> DataFrame:
    """Clean raw CSV into ``target``, by year and month; returns the rows left after each rule.

    The counts come from the writing pass itself.
    """
    raw = files.read_raw_csv(spark, source, name_filter)
    prepared, seen = quality.observed_funnel(raw, profile)
    clean = from_prepared(prepared, profile)
    # raw files hold a month each, so a task writes few folders and nothing needs to move
    sinks.write_parquet(clean, target, partition_by=_periods(clean))
    return quality.funnel_table(spark, seen.get)


def _periods(df: DataFrame) -> tuple[str, ...]:
    return tuple(n for n in ("year", "month") if n in df.columns)


def run_features(
    spark: SparkSession, source: str, target: str, strict_hour: bool = False
) -> None:
    """Feature table of all clean trips matching ``source``, by side of the split and month."""
    cells = aggregates.with_labels(aggregates.cell_hour(files.read_clean(spark, source)))
    table = features.feature_table(cells, strict_hour)
    sinks.write_parquet(table, target, partition_by=("dataset_split", "month"))


def run_snapshot(spark: SparkSession, source: str, target: str, months: str) -> None:
    """History snapshot for ``stream`` from the clean trips matching ``source``.

    Their months replace the same months of the sums below ``months`` and leave all others, so a
    new month costs its own trips. The snapshot replaces the one at ``target``.
    """
    history.add_months(aggregates.with_labels(aggregates.cell_hour(files.read_clean(spark, source))), months)
    sinks.write_parquet(history.snapshot(spark, months), target)


def run_training(
    spark: SparkSession, source: str, target: str, kinds=("rf", "gbt", "lr"),
    by_date: bool = True, **overrides
) -> DataFrame:
    """Fit, evaluate and compare the classifiers; the best by test F1 is stored.

    ``by_date`` takes the split of the table, otherwise rows are dealt 80:20 by a hash of their
    keys. Each model scores each side once; all reports come from those counts.
    """
    table, _ = files.read_features(spark, source)
    train, test = features.temporal_split(table) if by_date else features.hash_split(table)
    fitted = [f for f in ml.fit_all(train, kinds, **overrides) if f.model is not None]
    if not fitted:
        raise RuntimeError("no classifier could be fitted")
    outcomes = {f.kind: ml.outcomes(f, train, test) for f in fitted}
    comparison = ml.compare([ml.evaluation(f, outcomes[f.kind]) for f in fitted])
    sinks.write_parquet(comparison, f"{target}/comparison")
    stored = spark.read.parquet(f"{target}/comparison")
    best = stored.filter("best").first()["model"]
    winner = next(f for f in fitted if f.kind == best)
    ml.save(winner, outcomes[best], target)
    return stored


def run_scoring(spark: SparkSession, source: str, model: str, target: str) -> None:
    """Score a stored table that holds the model's inputs with a stored model."""
    rows = spark.read.parquet(source)
    sinks.write_parquet(ml.score(ml.load(model), rows), target)


def run_stream(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    snapshot: str | None = None,
    model: str | None = None,
    sinks_: tuple[str, ...] = ("raw", "windows", "scores", "state"),
    every: dict[str, str | None] | None = None,
    seconds: float | None = None,
    run: str = "main",
) -> None:
    """Parse trip events, score them, aggregate windows, and keep the chosen sinks going.

    ``source`` is a stream of GPS events with ``event_ts``. Each sink is a query with its own
    trigger (``every``, by sink) and its own checkpoint; the failure of one stops the set.
    ``scores`` needs the stored ``model`` and the history ``snapshot``, which is read anew for
    each batch. ``state`` is a log that merges its folders while the stream runs (read it with
    ``state_log``); ``keyed`` keeps the newest window per cell in the query's own store (read it
    with ``cell_state.read_cell_state``) and writes the changes.
    """
    every = {"keyed": "10 seconds", "raw": "30 seconds", "windows": "30 seconds", "scores": "10 seconds",
             "state": "10 seconds", "console": "10 seconds", **(every or {})}
    place = lambda name: (f"{target}/{name}", f"{target}/checkpoints/{run}/{name}")
    running = []
    for name in sinks_:
        path, checkpoint = place(name)
        if name == "raw":
            query = queries.start(source, queries.parquet(path), checkpoint, every=every[name])
        elif name == "windows":
            rows = windows.window_aggregates(source)
            query = queries.start(rows, queries.parquet(path), checkpoint, every=every[name])
        elif name == "console":
            rows = windows.window_aggregates(source)
            query = queries.start(rows, queries.console(), checkpoint, "update", every[name])
        elif name == "scores":
            fitted = ml.load(model)
            handle = queries.scoring_handler(
                enrich.refreshed(snapshot, lambda rows: ml.score(fitted, rows)), path
            )
            query = queries.to_batches(source, handle, checkpoint, every=every[name])
        elif name == "state":
            log = state_log.StateLog(spark, path, state_log.newest_rows("cell_id", "window_end"))
            rows = windows.window_aggregates(source)
            query = queries.to_batches(rows, log.handler(run), checkpoint, "update", every[name])
        elif name == "keyed":
            changes = state_log.StateLog(spark, path, state_log.all_rows())
            with cell_state.keyed_state(spark):
                rows = cell_state.cell_state_stream(source)
                query = queries.to_batches(rows, changes.handler(run), checkpoint, "update", every[name])
        else:
            raise ValueError(f"unknown sink {name!r}")
        running.append(query)
    queries.await_all(running, seconds)


def _event_stream(spark: SparkSession, args) -> DataFrame:
    if args.kafka:
        messages = queries.kafka_source(spark, args.kafka, args.input)
        return events.with_event_time(events.parse_messages(messages, GPS_EVENT))
    stream = queries.file_source(spark, args.input, GPS_EVENT, args.format)
    return events.with_event_time(stream)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=("clean", "features", "snapshot", "train", "score", "stream"))
    parser.add_argument("--input", required=True, help="path, or the topic with --kafka")
    parser.add_argument("--output", required=True)
    parser.add_argument("--master", help="left to spark-submit when not given")
    parser.add_argument("--target", choices=sorted(TARGETS), default="cluster")
    parser.add_argument("--default-fs", help="filesystem of paths that name none")
    parser.add_argument("--packages", default="", help="connector coordinates, by comma")
    parser.add_argument("--profile", choices=sorted(profiles.CLEAN_PROFILES), default="standard")
    parser.add_argument("--model", help="stored model, for score and stream")
    parser.add_argument("--snapshot", help="stored cell history, for stream")
    parser.add_argument("--history", help="sums by month, for snapshot")
    parser.add_argument("--kafka", help="servers of the event topic, for stream")
    parser.add_argument("--format", default="json", help="of event files, for stream")
    parser.add_argument("--sinks", default="raw,windows,state")
    parser.add_argument("--every", help="trigger of all sinks; none runs over what is there")
    parser.add_argument("--seconds", type=float, help="how long the stream runs")
    parser.add_argument("--run", default="main", help="name of the checkpoints")
    args = parser.parse_args()
    packages = tuple(p for p in args.packages.split(",") if p)
    spark = build_session(
        f"tripgrid-{args.step}", args.master, args.target, args.default_fs, packages
    )
    if args.step == "clean":
        profile = profiles.CLEAN_PROFILES[args.profile]
        run_cleaning(spark, args.input, args.output, profile).show()
    elif args.step == "features":
        run_features(spark, args.input, args.output)
    elif args.step == "snapshot":
        run_snapshot(spark, args.input, args.output, args.history or f"{args.output}-months")
    elif args.step == "train":
        run_training(spark, args.input, args.output).show()
    elif args.step == "score":
        run_scoring(spark, args.input, args.model, args.output)
    else:
        chosen = tuple(args.sinks.split(","))
        one = None if args.every in (None, "none") else args.every
        every = dict.fromkeys(chosen, one) if args.every else None
        run_stream(
            spark, _event_stream(spark, args), args.output, args.snapshot, args.model, chosen,
            every, args.seconds, args.run,
        )
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
