"""Traffic state, export and scoring-report queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripgrid.functions import grid, labels
from tripgrid.operators import ml, state
from tripgrid.operators.joins import join_predictions
from tripgrid.plans import views
from tripgrid.plans.registry import lit_ts, query
from tripgrid.plans.views import sql_from, sql_mean, sql_round
from tripgrid.streaming.windows import live_state

# the moment scoring rows are built for: a Tuesday in the morning rush
AS_OF = "2016-03-08 08:30:00"
CELL = "cell_24_26"


def as_of():
    return lit_ts(AS_OF)


@query("a20_traffic_state", sql_from("state", "SELECT * FROM state"))
def a20(spark, d):
    return views.traffic_state(spark, d)


@query("a21_overview", sql_from("state", f"""
SELECT count(*) AS total_cells, sum(vehicle_count)::BIGINT AS total_vehicles,
  {sql_round(sql_mean('congestion_index', 3), 3)} AS avg_congestion,
  {sql_round(sql_mean('avg_speed', 1), 1)} AS avg_speed,
  count(*) FILTER (congestion_level = 'low') AS low,
  count(*) FILTER (congestion_level = 'medium') AS medium,
  count(*) FILTER (congestion_level = 'high') AS high FROM state"""))
def a21(spark, d):
    return state.overview(views.traffic_state(spark, d))


_MIXED_SQL = """
, newest AS (SELECT max(event_ts) AS t FROM gps),
live AS (SELECT DISTINCT cell_id FROM gps, newest WHERE event_ts > t - INTERVAL 1 HOUR)
SELECT count(*) FILTER (l.cell_id IS NOT NULL) AS live_cells,
  count(*) FILTER (l.cell_id IS NULL) AS batch_cells, count(*) AS total
FROM (SELECT cell_id FROM state UNION SELECT cell_id FROM live) s LEFT JOIN live l USING (cell_id)"""


@query("a22_source_breakdown", sql_from("state", _MIXED_SQL, "gps"))
def a22(spark, d):
    """Batch state overlaid with the live records of the last hour, counted by source."""
    events = views.gps(spark, d)
    # a literal bound reaches the scan
    newest = events.agg(F.max("event_ts")).first()[0]
    recent = events.filter(F.col("event_ts") > F.lit(newest - dt.timedelta(hours=1)))
    both = views.traffic_state(spark, d).unionByName(live_state(recent))
    return state.source_breakdown(state.newest_source(both))


_STATE_ORDER = "ORDER BY congestion_index DESC, cell_id"


@query("o02_current_traffic", sql_from("state", f"""
SELECT * FROM state WHERE congestion_index >= 0.5 {_STATE_ORDER} LIMIT 500"""))
def o02(spark, d):
    return state.current_traffic(views.traffic_state(spark, d), min_index=0.5)


@query("o03_hotspots", sql_from("state", f"""
SELECT *, row_number() OVER ({_STATE_ORDER})::INT AS rank FROM state {_STATE_ORDER} LIMIT 10"""))
def o03(spark, d):
    return state.hotspots(views.traffic_state(spark, d))


# AS_OF lies in a rush hour, so the rule's rush test always holds
_RULE = """CASE WHEN avg_speed < 10 OR (avg_speed < 15 AND is_manhattan) THEN 2
  WHEN avg_speed < 20 THEN 1 ELSE 0 END"""
_SCORED = f"""
, scored AS (SELECT *, ({_RULE})::INT AS prediction FROM state),
rated AS (SELECT *, CASE prediction WHEN 2 THEN 0.82::DOUBLE WHEN 1 THEN 0.75::DOUBLE
    ELSE 0.80::DOUBLE END AS confidence,
  CASE prediction WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS predicted_level
  FROM scored)"""


@query("o04_cell_details", sql_from("state", _SCORED + f"""
SELECT cell_id, latitude, longitude, congestion_index, congestion_level, vehicle_count, avg_speed,
  predicted_level, round(prediction / 2.0::DOUBLE, 3) AS predicted_index, confidence, last_update
FROM rated WHERE cell_id = '{CELL}'"""))
def o04(spark, d):
    return state.cell_details(views.traffic_state(spark, d), CELL, as_of())


@query("x01_geojson_features", sql_from("state", """
SELECT cell_id, congestion_index, congestion_level, vehicle_count, avg_speed,
  trunc(congestion_index * 1000)::INT AS height,
  longitude - 0.0025::DOUBLE AS west, latitude - 0.0025::DOUBLE AS south,
  longitude + 0.0025::DOUBLE AS east, latitude + 0.0025::DOUBLE AS north, 5 AS ring_points
FROM state"""))
def x01(spark, d):
    """Polygon corners; the JSON text of each feature is parsed back to check it."""
    features = state.geojson_features(views.traffic_state(spark, d))
    shape = "struct<geometry: struct<coordinates: array<array<array<double>>>>>"
    ring = F.from_json("feature", shape).getField("geometry").getField("coordinates")[0]
    return features.withColumn("r", ring).select(
        "cell_id", "congestion_index", "congestion_level", "vehicle_count", "avg_speed", "height",
        F.expr("r[0][0]").alias("west"), F.expr("r[0][1]").alias("south"),
        F.expr("r[2][0]").alias("east"), F.expr("r[2][1]").alias("north"),
        F.size("r").alias("ring_points"),
    )


@query("x02_parse_cell_id", sql_from("clean", """
SELECT DISTINCT cell_id, cell_lat AS lat_index, cell_lon AS lon_index FROM clean"""))
def x02(spark, d):
    cells = views.clean(spark, d).select("cell_id").distinct()
    lat, lon = grid.parse_cell_id("cell_id")
    return cells.select("cell_id", lat.alias("lat_index"), lon.alias("lon_index"))


@query("j01_state_predictions", sql_from("state", _SCORED + """
SELECT cell_id, congestion_level, avg_speed, prediction, predicted_level, confidence,
  'rule-based' AS model_used FROM rated"""))
def j01(spark, d):
    current = views.traffic_state(spark, d)
    predicted = state.rule_predictions(state.scoring_rows(current, as_of()))
    return join_predictions(
        current.select("cell_id", "congestion_level", "avg_speed"), predicted
    )


@query("m13_scoring_rows", sql_from("state", """
SELECT cell_id, 8 AS hour, 3 AS day_of_week, 3 AS month, 0 AS is_weekend, 1 AS is_rush_hour,
  0 AS is_night, split_part(cell_id, '_', 2)::INT AS cell_lat,
  split_part(cell_id, '_', 3)::INT AS cell_lon, is_manhattan::INT AS is_manhattan_int,
  vehicle_count AS prev_trip_count, avg_speed AS prev_avg_speed,
  CASE congestion_level WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END::INT
    AS prev_congestion_label,
  vehicle_count * 0.9::DOUBLE AS prev_2h_trip_count, avg_speed * 1.1::DOUBLE AS prev_2h_avg_speed,
  vehicle_count::DOUBLE AS historical_avg_trips, avg_speed AS historical_avg_speed FROM state"""))
def m13(spark, d):
    return state.scoring_rows(views.traffic_state(spark, d), as_of())


@query("m14_prediction_report", sql_from("state", _SCORED + f"""
SELECT cell_id, latitude, longitude, congestion_level AS current_level,
  round(congestion_index, 3) AS current_index, predicted_level,
  round(prediction / 2.0::DOUBLE, 3) AS predicted_index, confidence,
  {sql_round('(prediction / 2.0::DOUBLE - congestion_index) * 100.0::DOUBLE', 1)} AS change_percent,
  'rule-based' AS model_used FROM rated WHERE confidence >= 0.7"""))
def m14(spark, d):
    current = views.traffic_state(spark, d)
    predicted = state.rule_predictions(state.scoring_rows(current, as_of()))
    return state.prediction_report(current, predicted)


# ---- evaluation of the rule on the feature table, derived from one count per outcome ----------

_OUTCOMES = """
, outcomes AS (SELECT congestion_label AS label, CASE WHEN prev_avg_speed < 10
    OR (prev_avg_speed < 15 AND is_rush_hour = 1 AND is_manhattan_int = 1) THEN 2
    WHEN prev_avg_speed < 20 THEN 1 ELSE 0 END::INT AS prediction FROM features),
report AS (SELECT c.class, count(*) FILTER (label = c.class AND prediction = c.class) AS tp,
    count(*) FILTER (label <> c.class AND prediction = c.class) AS fp,
    count(*) FILTER (label = c.class) AS support
  FROM outcomes, (VALUES (0), (1), (2)) c(class) GROUP BY c.class),
rates AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall FROM report),
scores AS (SELECT *,
    coalesce(2.0::DOUBLE * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rates)"""


def rule_outcomes(spark, d):
    rule = labels.state_rule("prev_avg_speed", "is_rush_hour", "is_manhattan_int")
    rows = views.feature_rows(spark, d).withColumn("prediction", rule.getField("prediction"))
    return ml.outcome_counts(rows)


@query("a23_confusion_matrix", sql_from("features", _OUTCOMES + """
SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
  count(*) FILTER (prediction = 1) AS predicted_1, count(*) FILTER (prediction = 2) AS predicted_2
FROM outcomes GROUP BY label"""))
def a23(spark, d):
    return ml.confusion_matrix(rule_outcomes(spark, d))


@query("a24_class_report", sql_from("features", _OUTCOMES + """
SELECT class, precision, recall, f1, support,
  CASE class WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS level FROM scores"""))
def a24(spark, d):
    return ml.class_report(rule_outcomes(spark, d))


@query("m09_weighted_metrics", sql_from("features", _OUTCOMES + """
SELECT round((SELECT count(*) FILTER (label = prediction)::DOUBLE / count(*) FROM outcomes), 9)
    AS accuracy,
  round(sum(precision * support) / sum(support), 9) AS weighted_precision,
  round(sum(recall * support) / sum(support), 9) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 9) AS weighted_f1 FROM scores"""))
def m09(spark, d):
    metrics = ml.weighted_metrics(rule_outcomes(spark, d))
    return metrics.select(*[F.round(c, 9).alias(c) for c in metrics.columns])


@query("m12_confidence_formula", sql_from("cells", """
, raw_scores AS (SELECT cell_id, hour_bucket, [least(avg_speed - 20.0::DOUBLE, 10.0::DOUBLE),
    least((15.0::DOUBLE - avg_speed) / 5.0::DOUBLE, 10.0::DOUBLE),
    least(10.0::DOUBLE - avg_speed, 10.0::DOUBLE)] AS s FROM cells)
SELECT cell_id, hour_bucket, round(exp(greatest(s[1], s[2], s[3]))
  / (exp(s[1]) + exp(s[2]) + exp(s[3])), 9) AS confidence FROM raw_scores"""))
def m12_formula(spark, d):
    """The softmax confidence on raw scores made of the mean speed."""
    speed = F.col("avg_speed")
    raw = F.array(speed - 20.0, (F.lit(15.0) - speed) / 5.0, F.lit(10.0) - speed)
    return views.labelled(spark, d).select(
        "cell_id", "hour_bucket", F.round(ml.confidence_from_raw(raw), 9).alias("confidence")
    )
