"""Event, window and stream queries.

Queries named ``*_stream`` run a streaming query over the files of a table until all input is
processed, and return what its sink holds. Their SQL twin is the batch answer, cut to windows
the final watermark has closed where the sink is append-only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tripgrid.functions import temporal
from tripgrid.operators import history, state
from tripgrid.operators.cleaning import clean_trips
from tripgrid.plans import views
from tripgrid.plans.registry import query, rounded
from tripgrid.plans.views import sql_from, sql_level, sql_mean, sql_piecewise, sql_round
from tripgrid.schemas import GPS_EVENT, TRIP_EVENT
from tripgrid.session import scratch_dir
from tripgrid.sources import fixtures
from tripgrid.streaming import cell_state, enrich, events, late, queries, state_log, windows

# ---- payloads -------------------------------------------------------------------------------


def _messages(spark, d):
    return events.to_messages(events.gps_events(views.clean(spark, d))).withColumn(
        "value", F.col("value").cast("binary")
    )


@query("r01_parse_messages", sql_from("gps", """
SELECT cell_id AS message_key, * EXCLUDE (event_ts) FROM gps"""))
def r01(spark, d):
    return events.parse_messages(_messages(spark, d), GPS_EVENT).drop("message_time")


@query("r01_parse_trip_messages", sql_from("trip_events", """
SELECT cell_id AS message_key, * EXCLUDE (event_ts) FROM trip_events"""))
def r01_trip(spark, d):
    messages = events.to_messages(events.trip_events(views.clean(spark, d)))
    return events.parse_messages(messages, TRIP_EVENT).drop("message_time")


@query("r02_event_time", sql_from("gps", """
SELECT event_id, event_ts, event_ts AS local_ts FROM gps"""))
def r02(spark, d):
    """ISO text with and without a zone; the session zone is UTC."""
    gps = events.with_event_time(events.gps_events(views.clean(spark, d)))
    local = F.regexp_replace("timestamp", "Z$", "")
    return events.with_event_time(gps.withColumn("local", local), "local").select(
        "event_id", temporal.from_iso_text("timestamp").alias("event_ts"),
        F.col("event_ts").alias("local_ts"),
    )


def _window_sql(view, size, speed, keys, extra="", where=""):
    return f"""
SELECT {', '.join(keys)}, count(*) AS trip_count, {sql_mean(speed, 2)} AS avg_speed,
  max({speed}) AS max_speed, min({speed}) AS min_speed, {extra}
  CASE WHEN {sql_mean(speed, 2)} >= 15 THEN 'Low' WHEN {sql_mean(speed, 2)} >= 8 THEN 'Medium'
       ELSE 'High' END AS congestion_level,
  time_bucket(INTERVAL {size}, event_ts) AS window_start,
  time_bucket(INTERVAL {size}, event_ts) + INTERVAL {size} AS window_end
FROM {view} GROUP BY {', '.join(keys)}, time_bucket(INTERVAL {size}, event_ts) {where}"""


_KEYS = ("cell_id", "cell_lat", "cell_lon")
_GENERIC = """WITH speeds AS (SELECT event_id, ts AS event_ts, event_type AS cell_id,
  least(60.0::DOUBLE, greatest(1.0::DOUBLE, value)) AS speed FROM events)"""


@query("r04_minute_windows", sql_from("gps", _window_sql("gps", "1 MINUTE", "speed", _KEYS)))
def r04(spark, d):
    return windows.window_aggregates(views.gps(spark, d))


@query("r04_hour_windows", _GENERIC + _window_sql("speeds", "1 HOUR", "speed", ("cell_id",)))
def r04_hour(spark, d):
    return windows.window_aggregates(
        fixtures.generic_events(spark, d), "1 hour", keys=("cell_id",)
    )


@query("r05_trip_windows", sql_from("trip_events", _window_sql(
    "trip_events", "1 MINUTE", "speed_mph", _KEYS,
    f"{sql_mean('trip_distance', 6)} AS avg_distance, {sql_mean('fare_amount', 6)} AS avg_fare,")))
def r05(spark, d):
    return windows.trip_window_aggregates(views.trip_events(spark, d))


@query("d10_two_minute_windows_doc", sql_from("gps", _window_sql(
    "gps", "2 MINUTE", "speed", _KEYS,
    "round(coalesce(stddev_samp(speed), 0), 6) AS speed_std,")))
def d10(spark, d):
    return rounded(
        windows.window_aggregates(views.gps(spark, d), "2 minutes", with_std=True), 6, ["speed_std"]
    )


@query("d06_alerts_doc", sql_from("gps", "SELECT * FROM (" + _window_sql(
    "gps", "1 MINUTE", "speed", _KEYS) + ") WHERE congestion_level = 'High'"))
def d06(spark, d):
    return windows.congestion_alerts(windows.window_aggregates(views.gps(spark, d)))


@query("r06_event_scoring", sql_from("trip_events", """
SELECT event_id, level AS congestion_level,
  CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END::INT AS prediction
FROM (SELECT event_id, CASE WHEN is_rush_hour = 1 AND is_manhattan = 1 THEN 'High'
        WHEN is_rush_hour = 1 OR speed_mph < 10 THEN 'Medium' ELSE 'Low' END AS level
      FROM trip_events)"""))
def r06(spark, d):
    scored = events.with_rule_prediction(views.trip_events(spark, d), "speed_mph")
    return scored.select("event_id", "congestion_level", "prediction")


_LIVE_SQL = f"""
SELECT cell_id, {sql_round('f.lat', 6)} AS latitude, {sql_round('f.lon', 6)} AS longitude,
  {sql_round(sql_piecewise('speed', 0.05, 0.98), 3)} AS congestion_index,
  {sql_level('speed', 'low', 'medium', 'high', '>')} AS congestion_level, vehicle_count,
  {sql_round('speed', 1)} AS avg_speed, trunc(mean_hour)::INT AS hour, f.zone = 1 AS is_manhattan,
  window_start + INTERVAL 5 SECOND AS last_update, 'live' AS source
FROM (SELECT cell_id, time_bucket(INTERVAL 5 SECOND, event_ts) AS window_start,
        {sql_mean('speed', 2)} AS speed, count(*) AS vehicle_count, avg(hour) AS mean_hour,
        min({{'ts': event_ts, 'lat': latitude, 'lon': longitude, 'zone': is_manhattan}}) AS f
      FROM gps GROUP BY cell_id, window_start)"""


@query("r08_live_state", sql_from("gps", _LIVE_SQL))
def r08(spark, d):
    return windows.live_state(views.gps(spark, d))


_BRIDGE_SQL = f"""
, w AS ({_window_sql('gps', '1 MINUTE', 'speed', _KEYS)}),
newest AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY window_end DESC)
  = 1)
SELECT cell_id, {sql_round('40.4855::DOUBLE + cell_lat * 0.01::DOUBLE', 6)} AS latitude,
  {sql_round('-74.2567::DOUBLE + cell_lon * 0.01::DOUBLE', 6)} AS longitude,
  CASE congestion_level WHEN 'Low' THEN 0.3::DOUBLE WHEN 'High' THEN 0.85::DOUBLE
    ELSE 0.55::DOUBLE END AS congestion_index, lower(congestion_level) AS congestion_level,
  trip_count AS vehicle_count, {sql_round('avg_speed', 1)} AS avg_speed,
  {sql_round('max_speed', 1)} AS max_speed, {sql_round('min_speed', 1)} AS min_speed, window_end AS last_update, 'stream' AS source FROM newest"""


@query("r09_latest_state", sql_from("gps", _BRIDGE_SQL))
def r09(spark, d):
    records = windows.window_aggregates(views.gps(spark, d))
    return state.bridge_state(state.latest_per_key(records, "cell_id", "window_end"))


@query("r10_event_rate", sql_from("gps", """
SELECT date_trunc('second', event_ts) AS second, count(*) AS events_per_second,
  count(DISTINCT cell_id) AS active_cells FROM gps GROUP BY 1"""))
def r10(spark, d):
    return windows.event_rate(windows.second_counts(views.gps(spark, d)))


@query("r10_event_rate_stream", sql_from("gps", """
SELECT date_trunc('second', event_ts) AS second, count(*) AS events_per_second,
  count(DISTINCT cell_id) AS active_cells FROM gps GROUP BY 1
HAVING date_trunc('second', event_ts) + INTERVAL 1 SECOND
  <= (SELECT max(event_ts) FROM gps) - INTERVAL 2 MINUTE"""))
def r10_stream(spark, d):
    """Counts per second and cell from a stream, rolled up on reading."""
    counts = windows.second_counts(gps_stream(spark, d))
    return windows.event_rate(_run_to_parquet(spark, counts, "rate"))


@query("k10_message_payload", sql_from("gps", f"""
SELECT cell_id AS key, trip_count, avg_speed, congestion_level, window_start
FROM ({_window_sql('gps', '1 MINUTE', 'speed', _KEYS)})"""))
def k10(spark, d):
    """Key and value of the prediction topic, the value parsed back from its JSON text."""
    messages = events.to_messages(windows.window_aggregates(views.gps(spark, d)))
    shape = "trip_count bigint, avg_speed double, congestion_level string, window_start timestamp"
    return messages.select("key", F.from_json("value", shape).alias("v")).select("key", "v.*")


_SNAPSHOT_SQL = """
, history AS (SELECT cell_lat, cell_lon, hour, avg(trip_count) AS historical_avg_trips,
    sum(floor(avg_speed * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT)::DOUBLE / (count(*) * 1e6::DOUBLE)
      AS historical_avg_speed FROM lagged GROUP BY ALL),
newest AS (SELECT cell_lat, cell_lon, trip_count AS prev_trip_count, avg_speed AS prev_avg_speed,
    congestion_label AS prev_congestion_label, prev_trip_count AS prev_2h_trip_count,
    prev_avg_speed AS prev_2h_avg_speed FROM lagged
  QUALIFY row_number() OVER (PARTITION BY cell_lat, cell_lon ORDER BY hour_bucket DESC) = 1)
SELECT event_id, event_ts, cell_id, speed, hour, day_of_week, month(event_ts)::INT AS month,
  is_weekend, is_rush_hour, is_night, g.cell_lat, g.cell_lon, is_manhattan AS is_manhattan_int,
  coalesce(prev_trip_count, 10) AS prev_trip_count,
  coalesce(prev_avg_speed, 15.0::DOUBLE) AS prev_avg_speed,
  coalesce(prev_congestion_label, 1) AS prev_congestion_label,
  coalesce(prev_2h_trip_count, 0) AS prev_2h_trip_count,
  coalesce(prev_2h_avg_speed, 0) AS prev_2h_avg_speed,
  coalesce(historical_avg_trips, 10.0::DOUBLE) AS historical_avg_trips,
  coalesce(historical_avg_speed, 15.0::DOUBLE) AS historical_avg_speed
FROM {events} g LEFT JOIN history USING (cell_lat, cell_lon, hour)
  LEFT JOIN newest USING (cell_lat, cell_lon)"""


def _snapshot_sql(events="gps", history=""):
    return _SNAPSHOT_SQL.replace("{events}", events).replace("FROM lagged", f"FROM lagged {history}", 1)


@query("j04_enriched_events", sql_from("lagged", _snapshot_sql(), "gps"))
def j04(spark, d):
    path = scratch_dir(spark, "snapshot")
    enrich.history_snapshot(views.labelled(spark, d)).write.parquet(path)
    return enrich.enrich_events(views.gps(spark, d), spark.read.parquet(path))


_STRANGE_SQL = """, strange AS (SELECT * REPLACE ((hour + 11) % 24 AS hour,
  CASE WHEN cell_lat % 3 = 0 THEN cell_lon + 500 ELSE cell_lon END AS cell_lon) FROM gps)"""


@query("j04_events_beyond_history", sql_from(
    "lagged", _STRANGE_SQL + _snapshot_sql("strange", "WHERE hour < 12"), "gps"))
def j04_beyond(spark, d):
    """Events at hours their cell was never seen in keep the lags; unknown cells get stand-ins.

    History is cut to the hours before noon, the lags are not.
    """
    path = scratch_dir(spark, "snapshot")
    snapshot = enrich.history_snapshot(views.labelled(spark, d))
    means = ("historical_avg_trips", "historical_avg_speed")
    seen = {c: F.when(F.col("hour") < 12, F.col(c)) for c in means}
    snapshot.withColumns(seen).write.parquet(path)
    strange = views.gps(spark, d).withColumns({
        "hour": ((F.col("hour") + 11) % 24).cast("int"),
        "cell_lon": F.when(F.col("cell_lat") % 3 == 0, F.col("cell_lon") + 500)
        .otherwise(F.col("cell_lon")),
    })
    return enrich.enrich_events(strange, spark.read.parquet(path))


# ---- streams --------------------------------------------------------------------------------


def table_stream(spark, sf_dir: str, name: str):
    """A test table as a file stream; a stream source takes a folder or glob, not one file."""
    schema = fixtures.table(spark, sf_dir, name).schema
    return queries.file_source(spark, f"{sf_dir}/{name}.parquet*", schema)


def gps_stream(spark, d):
    trips = fixtures.trips_from_lineitem(table_stream(spark, d, "lineitem")).drop("l_orderkey")
    return events.with_event_time(events.gps_events(clean_trips(trips)))


def _run_to_parquet(spark, df, purpose: str, partition_by: tuple[str, ...] = ()):
    """Run ``df`` into a Parquet sink until its input is used up and read the sink."""
    folder = scratch_dir(spark, purpose)
    sink = queries.parquet(f"{folder}/data", partition_by)
    queries.await_all([queries.start(df, sink, f"{folder}/checkpoint", every=None)])
    return spark.read.schema(df.schema).parquet(f"{folder}/data")


_CLOSED = """HAVING time_bucket(INTERVAL {size}, event_ts) + INTERVAL {size}
  <= (SELECT max(event_ts) FROM {view}) - INTERVAL 2 MINUTE"""


@query("s08_file_stream", """
SELECT event_id, ts AS event_ts, event_type AS cell_id,
  least(60.0::DOUBLE, greatest(1.0::DOUBLE, value)) AS speed FROM events""")
def s08(spark, d):
    return _run_to_parquet(
        spark, fixtures.with_speed(table_stream(spark, d, "events")), "source"
    )


@query("r03_closed_windows_stream", _GENERIC + _window_sql(
    "speeds", "1 MINUTE", "speed", ("cell_id",),
    where=_CLOSED.format(size="1 MINUTE", view="speeds")))
def r03(spark, d):
    """Append-only windows: those the two-minute watermark has closed."""
    speeds = fixtures.with_speed(table_stream(spark, d, "events"))
    return _run_to_parquet(
        spark, windows.window_aggregates(speeds, keys=("cell_id",)), "watermark"
    )


@query("r04_minute_windows_stream", sql_from("gps", _window_sql(
    "gps", "1 MINUTE", "speed", _KEYS, where=_CLOSED.format(size="1 MINUTE", view="gps"))))
def r04_stream(spark, d):
    return _run_to_parquet(spark, windows.window_aggregates(gps_stream(spark, d)), "windows")


@query("r07_scored_batches_stream", sql_from("gps", """
SELECT event_id, level AS congestion_level,
  CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END::INT AS prediction
FROM (SELECT event_id, CASE WHEN is_rush_hour = 1 AND is_manhattan = 1 THEN 'High'
        WHEN is_rush_hour = 1 OR speed < 10 THEN 'Medium' ELSE 'Low' END AS level FROM gps)"""))
def r07(spark, d):
    folder = scratch_dir(spark, "scored")
    handle = queries.scoring_handler(
        lambda batch: events.with_rule_prediction(batch).select(
            "event_id", "congestion_level", "prediction"
        ),
        f"{folder}/data",
    )
    queries.await_all([
        queries.to_batches(gps_stream(spark, d), handle, f"{folder}/checkpoint", every=None)
    ])
    return spark.read.parquet(f"{folder}/data").drop("run", "epoch")


@query("r09_latest_state_stream", sql_from("gps", _BRIDGE_SQL))
def r09_stream(spark, d):
    """Newest window per cell, kept as a changelog by an update-mode stream."""
    folder = scratch_dir(spark, "state")
    handle = queries.changelog_handler(f"{folder}/data", "cell_id", "window_end")
    aggregated = windows.window_aggregates(gps_stream(spark, d))
    queries.await_all([
        queries.to_batches(aggregated, handle, f"{folder}/checkpoint", mode="update", every=None)
    ])
    return state.bridge_state(queries.read_state(spark, f"{folder}/data", "cell_id", "window_end"))


@query("r11_query_set_stream", sql_from("gps", """
SELECT count(*) AS raw_events, count(DISTINCT cell_id) AS cells FROM gps"""))
def r11(spark, d):
    """Raw events and window aggregates as two queries of one set, each with its checkpoint."""
    folder = scratch_dir(spark, "set")
    source = gps_stream(spark, d)
    queries.await_all([
        queries.start(source, queries.parquet(f"{folder}/raw"), f"{folder}/c-raw", every=None),
        queries.start(
            windows.window_aggregates(source), queries.parquet(f"{folder}/agg"),
            f"{folder}/c-agg", every=None,
        ),
    ])
    raw = spark.read.schema(source.schema).parquet(f"{folder}/raw")
    return raw.agg(
        F.count(F.lit(1)).alias("raw_events"), F.countDistinct("cell_id").alias("cells")
    )


def _progress(spark, stream):
    folder = scratch_dir(spark, "progress")
    totals = queries.watch_progress(spark)
    sink = queries.parquet(f"{folder}/data")
    running = queries.start(stream, sink, f"{folder}/checkpoint", every=None)
    queries.await_all([running])
    summary = queries.progress_summary(running, totals)
    spark.streams.removeListener(totals)
    return spark.createDataFrame(
        [(summary["active"], summary["batches"], summary["input_rows"])],
        "active boolean, batches bigint, input_rows bigint",
    )


@query("r12_progress_stream", """
SELECT true AS active, count(*) AS input_rows FROM events""")
def r12(spark, d):
    stream = fixtures.with_speed(table_stream(spark, d, "events"))
    return _progress(spark, stream).drop("batches")


@query("r12_progress_many_batches_stream", """
SELECT true AS active, 105::BIGINT AS batches, count(*) AS input_rows FROM events""")
def r12_many(spark, d):
    """More batches than a query remembers: one file each."""
    path = scratch_dir(spark, "many")
    table = fixtures.table(spark, d, "events")
    table.repartitionByRange(105, "event_id").write.parquet(path)
    return _progress(spark, queries.file_source(spark, path, table.schema, files_per_batch=1))


@query("k08_partitioned_sink_stream", _GENERIC + """
SELECT cell_id, count(*) AS row_count, count(DISTINCT event_id) AS events FROM speeds
GROUP BY cell_id""")
def k08(spark, d):
    speeds = fixtures.with_speed(table_stream(spark, d, "events"))
    stored = _run_to_parquet(spark, speeds, "partitioned", partition_by=("cell_id",))
    return stored.groupBy("cell_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("event_id").alias("events")
    )


@query("k09_raw_and_aggregate_stream", _GENERIC + """
SELECT (SELECT count(*) FROM speeds) AS raw_rows, count(*) AS window_rows,
  sum(n)::BIGINT AS windowed_events
FROM (SELECT count(*) AS n FROM speeds GROUP BY cell_id, time_bucket(INTERVAL 1 HOUR, event_ts)
  HAVING time_bucket(INTERVAL 1 HOUR, event_ts) + INTERVAL 1 HOUR
    <= (SELECT max(event_ts) FROM speeds) - INTERVAL 2 MINUTE)""")
def k09(spark, d):
    folder = scratch_dir(spark, "sinks")
    speeds = fixtures.with_speed(table_stream(spark, d, "events"))
    hourly = windows.window_aggregates(speeds, "1 hour", keys=("cell_id",))
    queries.await_all([
        queries.start(speeds, queries.parquet(f"{folder}/raw"), f"{folder}/c-raw", every=None),
        queries.start(hourly, queries.parquet(f"{folder}/agg"), f"{folder}/c-agg", every=None),
    ])
    raw = spark.read.schema(speeds.schema).parquet(f"{folder}/raw")
    stored = spark.read.schema(hourly.schema).parquet(f"{folder}/agg")
    return stored.agg(
        F.count(F.lit(1)).alias("window_rows"), F.sum("trip_count").alias("windowed_events")
    ).select(raw.agg(F.count(F.lit(1))).scalar().alias("raw_rows"), "window_rows", "windowed_events")


@query("j04_enriched_events_stream", sql_from("lagged", _snapshot_sql(), "gps"))
def j04_stream(spark, d):
    """The stream joined with the stored snapshot."""
    path = scratch_dir(spark, "snapshot")
    enrich.history_snapshot(views.labelled(spark, d)).write.parquet(path)
    enriched = enrich.enrich_events(gps_stream(spark, d), spark.read.parquet(path))
    return _run_to_parquet(spark, enriched, "enriched")


_LOG_SQL = """
SELECT l_orderkey % 500 AS k, 1 + max(l_linenumber) AS newest, {value} AS v
FROM lineitem GROUP BY l_orderkey % 500"""


def _changes(spark, d, value):
    line = fixtures.table(spark, d, "lineitem")
    key = (F.col("l_orderkey") % 500).alias("k")
    return line.groupBy(key).agg((1 + F.max("l_linenumber")).alias("newest"), value.alias("v"))


@query("r09_equal_times", _LOG_SQL.format(value="min(l_suppkey)"))
def r09_equal(spark, d):
    """Two batches with the same time: the later one wins, even with the smaller value."""
    path = scratch_dir(spark, "log")
    handle = queries.changelog_handler(path, "k", "newest")
    handle(_changes(spark, d, F.max("l_suppkey")), 0)
    handle(_changes(spark, d, F.min("l_suppkey")), 1)
    return queries.read_state(spark, path, "k", "newest")


@query("r09_restarted_stream", """
SELECT l_orderkey % 500 AS k, 1 + max(l_linenumber) AS newest,
  CASE WHEN l_orderkey % 500 < 250 THEN min(l_suppkey) ELSE max(l_suppkey) END AS v
FROM lineitem GROUP BY l_orderkey % 500""")
def r09_restarted(spark, d):
    """A restart with a new checkpoint counts its batches from 0 again and erases nothing."""
    path = scratch_dir(spark, "log")
    queries.changelog_handler(path, "k", "newest")(_changes(spark, d, F.max("l_suppkey")), 0)
    second = _changes(spark, d, F.min("l_suppkey")).filter("k < 250")
    queries.changelog_handler(path, "k", "newest")(second, 0)
    return queries.read_state(spark, path, "k", "newest")


# ---- state inside the stream, logs under a manifest, late rows ------------------------------


@query("r09_keyed_state_stream", sql_from("gps", _BRIDGE_SQL))
def r09_keyed(spark, d):
    """Newest window per cell in the stream's own store, in two runs of one checkpoint."""
    folder = scratch_dir(spark, "keyed")
    table = fixtures.table(spark, d, "lineitem")
    for half in (0, 1):
        # the second run finds new files and the state the first one left
        table.filter(F.col("l_orderkey") % 2 == half).write.mode("append").parquet(f"{folder}/in")
        source = queries.file_source(spark, f"{folder}/in", table.schema)
        gps = events.with_event_time(events.gps_events(clean_trips(
            fixtures.trips_from_lineitem(source).drop("l_orderkey"))))
        with cell_state.keyed_state(spark):
            running = queries.start(
                cell_state.cell_state_stream(gps), queries.Sink("noop"), f"{folder}/checkpoint",
                mode="update", every=None,
            )
            queries.await_all([running])
    return state.bridge_state(cell_state.read_cell_state(spark, f"{folder}/checkpoint"))


@query("r09_state_log_stream", sql_from("gps", _BRIDGE_SQL))
def r09_log(spark, d):
    """Newest window per cell in a log that merges its folders while the stream runs.

    Batches come in no order of time. A batch logs the sums of each cell's newest window and the
    log adds up those of equal windows, so no window is held open for rows still to come. A batch is
    as many files as there are cores, so all of them work on it.
    """
    folder = scratch_dir(spark, "log")
    log = state_log.StateLog(spark, f"{folder}/log", cell_state.newest_sums, every=2)
    table = fixtures.table(spark, d, "lineitem")
    files = spark.sparkContext.defaultParallelism
    table.repartition(5 * files, "l_orderkey").write.parquet(f"{folder}/in")
    source = queries.file_source(spark, f"{folder}/in", table.schema, files_per_batch=files)
    gps = events.with_event_time(events.gps_events(clean_trips(
        fixtures.trips_from_lineitem(source).drop("l_orderkey"))))
    queries.await_all([queries.to_batches(
        cell_state.partial_windows(gps), log.handler("main"), f"{folder}/checkpoint", every=None
    )])
    return state.bridge_state(cell_state.as_windows(log.read()))


@query("r09_log_of_many_batches", """
SELECT k, max(v) AS v, count(*) AS n FROM (
  SELECT l_orderkey % 50 AS k, max(l_orderkey) AS v FROM lineitem GROUP BY l_orderkey % 50, l_orderkey % 16)
GROUP BY k""")
def r09_many(spark, d):
    """Sixteen batches, merged in tiers of four; ``n`` counts the batches that touched a key."""
    path = scratch_dir(spark, "log")
    line = fixtures.table(spark, d, "lineitem").select("l_orderkey")
    key = (F.col("l_orderkey") % 50).alias("k")
    changes = line.groupBy(key, (F.col("l_orderkey") % 16).alias("batch")).agg(F.max("l_orderkey").alias("v"))
    stored = scratch_dir(spark, "changes")
    changes.withColumn("n", F.lit(1).cast("long")).write.parquet(stored)

    def add(rows):
        return rows.drop(state_log.SEQ).groupBy("k").agg(F.max("v").alias("v"), F.sum("n").alias("n"))

    log = state_log.StateLog(spark, path, add, every=4)
    for epoch in range(16):
        log.append(spark.read.parquet(stored).filter(F.col("batch") == epoch).drop("batch"), "main", epoch)
    if len(log.current()[1]["entries"]) > 6:
        raise RuntimeError("the log does not merge its folders")
    return log.read()


@query("r10_chained_rate_stream", sql_from("gps", """
SELECT date_trunc('second', event_ts) AS second, count(*) AS events_per_second,
  count(DISTINCT cell_id) AS active_cells FROM gps GROUP BY 1
HAVING date_trunc('second', event_ts) + INTERVAL 1 SECOND
  <= (SELECT max(event_ts) FROM gps) - INTERVAL 2 MINUTE"""))
def r10_chained(spark, d):
    """Exact rates from one query of two aggregations."""
    return _run_to_parquet(spark, windows.chained_event_rate(gps_stream(spark, d)), "chained")


_LATE_SQL = """
, marked AS (
  SELECT *, (SELECT max(event_ts) FROM speeds b WHERE b.event_id % 5 < a.event_id % 5) - INTERVAL 2 MINUTE AS mark,
    time_bucket(INTERVAL 1 HOUR, event_ts) + INTERVAL 1 HOUR AS window_end
  FROM speeds a),
judged AS (SELECT *, coalesce(window_end <= mark, false) AS late FROM marked)
"""


def _late_run(spark, d):
    """Hourly windows over five batches of events, each of which reaches over the whole time."""
    folder = scratch_dir(spark, "late")
    table = fixtures.table(spark, d, "events")
    found = late.LateKeepingWindows(spark, f"{folder}/out", ("cell_id",), "1 hour", every=2)
    for k in range(5):
        table.filter(F.col("event_id") % 5 == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = queries.file_source(spark, f"{folder}/in", table.schema)
        queries.await_all([queries.to_batches(
            fixtures.with_speed(source), found.handle("main"), f"{folder}/checkpoint", every=None
        )])
    return found


@query("r03_late_rows_stream", _GENERIC + _LATE_SQL + """
SELECT event_id, event_ts, cell_id FROM judged WHERE late""")
def r03_late(spark, d):
    """The very rows the watermark shuts out."""
    return _late_run(spark, d).late_rows().select("event_id", "event_ts", "cell_id")


@query("r03_kept_and_late_stream", _GENERIC + _LATE_SQL + """
SELECT count(*) AS input_rows, count(*) FILTER (NOT late) AS kept_rows, count(*) FILTER (late) AS late_rows
FROM judged""")
def r03_both(spark, d):
    """Kept and late rows, which together are the input."""
    found = _late_run(spark, d)
    kept = found.windows(closed_only=False).agg(F.sum("trip_count")).scalar()
    return found.late_rows().agg(F.count(F.lit(1)).alias("late_rows")).select(
        (kept + F.col("late_rows")).alias("input_rows"), kept.alias("kept_rows"), "late_rows"
    )


@query("k08_hot_cell_stream", _GENERIC + """
SELECT cell_id, count(*) AS row_count, count(DISTINCT event_id) AS events,
  least(ceil(count(*) / 500.0)::BIGINT, 2) AS parts FROM speeds GROUP BY cell_id""")
def k08_hot(spark, d):
    """Files by cell, in parts of about 500 rows; ``parts`` says whether a cell was split (2: or more)."""
    folder = scratch_dir(spark, "spread")
    handle = queries.spread_handler(f"{folder}/data", ("cell_id",), rows_per_file=500)
    speeds = fixtures.with_speed(table_stream(spark, d, "events"))
    queries.await_all([queries.to_batches(speeds, handle, f"{folder}/checkpoint", every=None)])
    stored = spark.read.parquet(f"{folder}/data").withColumn("file", F.input_file_name())
    return stored.groupBy("cell_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("event_id").alias("events"),
        F.least(F.countDistinct("file"), F.lit(2)).alias("parts"),
    )


@query("k07_console_stream", """
SELECT true AS active, count(*) AS input_rows FROM events""")
def k07(spark, d):
    """Rows that went through the console sink."""
    folder = scratch_dir(spark, "console")
    totals = queries.watch_progress(spark)
    stream = fixtures.with_speed(table_stream(spark, d, "events"))
    running = queries.start(stream, queries.console(rows=1), f"{folder}/checkpoint", every=None)
    queries.await_all([running])
    summary = queries.progress_summary(running, totals)
    spark.streams.removeListener(totals)
    return spark.createDataFrame([(summary["active"], summary["input_rows"])], "active boolean, input_rows bigint")


# ---- history as of a moment, and by months --------------------------------------------------

_AS_OF_SQL = """
, asked AS (SELECT DISTINCT cell_lat, cell_lon, hour, date_trunc('hour', event_ts) AS at FROM gps),
newest AS (SELECT a.cell_lat, a.cell_lon, a.at, l.trip_count AS prev_trip_count,
    l.avg_speed AS prev_avg_speed, l.congestion_label AS prev_congestion_label,
    l.prev_trip_count AS prev_2h_trip_count, l.prev_avg_speed AS prev_2h_avg_speed
  FROM asked a JOIN lagged l ON l.cell_lat = a.cell_lat AND l.cell_lon = a.cell_lon AND l.hour_bucket < a.at
  QUALIFY row_number() OVER (PARTITION BY a.cell_lat, a.cell_lon, a.at ORDER BY l.hour_bucket DESC) = 1),
history AS (SELECT a.cell_lat, a.cell_lon, a.at, avg(l.trip_count) AS historical_avg_trips,
    sum(floor(l.avg_speed * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT)::DOUBLE / (count(*) * 1e6::DOUBLE)
      AS historical_avg_speed
  FROM asked a JOIN lagged l ON l.cell_lat = a.cell_lat AND l.cell_lon = a.cell_lon
    AND l.hour = a.hour AND l.hour_bucket < a.at GROUP BY ALL)
SELECT event_id, event_ts, cell_id, speed, g.hour, day_of_week, month(event_ts)::INT AS month,
  is_weekend, is_rush_hour, is_night, g.cell_lat, g.cell_lon, is_manhattan AS is_manhattan_int,
  coalesce(prev_trip_count, 10) AS prev_trip_count,
  coalesce(prev_avg_speed, 15.0::DOUBLE) AS prev_avg_speed,
  coalesce(prev_congestion_label, 1) AS prev_congestion_label,
  coalesce(prev_2h_trip_count, 0) AS prev_2h_trip_count,
  coalesce(prev_2h_avg_speed, 0) AS prev_2h_avg_speed,
  coalesce(historical_avg_trips, 10.0::DOUBLE) AS historical_avg_trips,
  coalesce(historical_avg_speed, 15.0::DOUBLE) AS historical_avg_speed
FROM gps g
  LEFT JOIN newest n ON n.cell_lat = g.cell_lat AND n.cell_lon = g.cell_lon AND n.at = date_trunc('hour', g.event_ts)
  LEFT JOIN history h ON h.cell_lat = g.cell_lat AND h.cell_lon = g.cell_lon AND h.at = date_trunc('hour', g.event_ts)"""


@query("j04_as_of_events", sql_from("lagged", _AS_OF_SQL, "gps"))
def j04_as_of(spark, d):
    """Events with what was known of their cell when their hour began."""
    return enrich.enrich_as_of(views.gps(spark, d), views.labelled(spark, d))


@query("j04_events_with_monthly_history", sql_from("lagged", _snapshot_sql(), "gps"))
def j04_months(spark, d):
    """The snapshot built up by months, the second of them twice."""
    path = scratch_dir(spark, "months")
    cells = views.labelled(spark, d)
    for month in (2, 1, 3, 2):
        history.add_months(cells.filter(F.col("month") == month), path)
    stored = scratch_dir(spark, "snapshot")
    history.snapshot(spark, path).write.parquet(stored)
    return enrich.enrich_events(views.gps(spark, d), spark.read.parquet(stored))


@query("w02_monthly_history", sql_from("cells", f"""
SELECT cell_lat, cell_lon, hour, avg(trip_count) AS historical_avg_trips,
  {sql_mean('avg_speed', 6)} AS historical_avg_speed FROM cells GROUP BY ALL"""))
def w02_months(spark, d):
    path = scratch_dir(spark, "months")
    cells = views.labelled(spark, d)
    for month in (1, 2, 3):
        history.add_months(cells.filter(F.col("month") == month), path)
    return history.hourly_means(spark, path)
