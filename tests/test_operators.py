"""Operators against brute force on small inputs, ties and gaps included."""

import datetime as dt
import math
import random
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripgrid import profiles
from tripgrid.functions.numeric import stable_avg
from tripgrid.operators import aggregates, analysis, features, joins, ml, quantiles, rollups, state
from tripgrid.plans import views
from tripgrid.sources import sinks
from tripgrid.streaming import events

HOUR = dt.datetime(2016, 1, 1)
CELLS = """cell_id string, cell_lat int, cell_lon int, hour_bucket timestamp, hour int,
    trip_count bigint, avg_speed double, congestion_label int"""


def cell_rows(hours, cell=(1, 2)):
    return [
        (f"cell_{cell[0]}_{cell[1]}", *cell, HOUR + dt.timedelta(hours=h), h % 24, 10 + h,
         float(5 + h), 1)
        for h in hours
    ]


def test_row_lag_skips_gaps_and_strict_lag_does_not(spark):
    cells = spark.createDataFrame(cell_rows([0, 1, 3]), CELLS)
    row = lambda df: df.orderBy("hour_bucket").collect()[-1]
    by_row, strict = row(features.with_lags(cells)), row(features.with_lags(cells, True))
    assert (by_row["prev_trip_count"], by_row["prev_2h_trip_count"]) == (11, 10)
    assert (strict["prev_trip_count"], strict["prev_2h_trip_count"]) == (None, 11)


def test_history_includes_the_row_itself(spark):
    cells = spark.createDataFrame(cell_rows([0, 24, 48]), CELLS)
    found = {r["historical_avg_trips"] for r in features.with_history(cells).collect()}
    assert found == {(10 + 34 + 58) / 3}


def test_single_trip_has_zero_deviation(spark):
    cells = aggregates.cell_hour(views.clean(spark, SMALL))
    assert cells.filter("trip_count = 1 AND speed_std <> 0").count() == 0
    assert cells.filter("speed_std IS NULL").count() == 0


def test_stable_mean_does_not_depend_on_partitioning(spark):
    values = [(round(random.Random(i).uniform(1, 60), 2),) for i in range(2000)]
    df = spark.createDataFrame(values, "v double")
    found = {df.repartition(n).agg(stable_avg("v")).first()[0] for n in (1, 3, 8)}
    assert found == {sum(round(v * 100) for v, in values) / (100 * len(values))}


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0] * 300 + [1.0, 9.0], [i / 7 for i in range(101)],
    [random.Random(3).gauss(10, 4) for _ in range(500)] + [12.5] * 250,
])
@pytest.mark.parametrize("limits", [{}, {"slots": 4, "largest": 3}])
def test_exact_quantiles(spark, values, limits):
    df = spark.createDataFrame([("k", v) for v in values] + [("z", 1.5), ("z", None)],
                               "k string, v double")
    found = {r["k"]: r for r in analysis.exact_quantiles(
        df, "v", {"q0": 0.0, "q25": 0.25, "median": 0.5, "q100": 1.0}, ("k",), **limits
    ).collect()}
    assert found["k"]["value_count"] == len(values)
    assert found["k"]["median"] == pytest.approx(statistics.median(values))
    assert (found["k"]["q0"], found["k"]["q100"]) == (min(values), max(values))
    if len(values) > 1:
        expected = statistics.quantiles(values, n=4, method="inclusive")[0]
        assert found["k"]["q25"] == pytest.approx(expected)
    assert found["z"]["median"] == 1.5


EXTREMES = [-1.7e308, -1.0, -5e-324, 0.0, 5e-324, 2.2250738585072014e-308, 1e-300, 1.0, 1.7e308]


def test_ordered_form_follows_the_bits(spark):
    rng = random.Random(4)
    values = [*EXTREMES, -0.0, 1.7976931348623157e308, 2.225073858507201e-308]
    values += [s * math.ldexp(1.0, e) for e in range(-1074, 1024, 7) for s in (1, -1)]
    values += [math.nextafter(math.ldexp(1.0, e), d) for e in (-1022, -52, -1, 0, 1, 52, 1023) for d in (0.0, math.inf)]
    values += [struct.unpack("<d", struct.pack("<q", rng.getrandbits(63)))[0] for _ in range(3000)]
    values = [v for v in values if math.isfinite(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", quantiles.ordered_form("v").alias("o")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(row["v"])))[0]
        assert row["o"] == (-bits if row["v"] < 0 else bits), row["v"]


@pytest.mark.parametrize("slots", [2, 1024])
def test_quantiles_of_extreme_doubles_end(spark, slots):
    rng = random.Random(8)
    values = EXTREMES + [rng.choice((1, -1)) * 10.0 ** rng.randrange(-300, 300) for _ in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = quantiles.exact_quantiles(df, "v", {f"q{k}": k / 48 for k in range(49)}, slots=slots, largest=2).first()
    assert [found[f"q{k}"] for k in range(49)] == sorted(values)
    wide = spark.createDataFrame([(-1.7e308,), (1.7e308,)], "v double")
    assert quantiles.exact_quantiles(wide, "v", {"m": 0.5}).first()["m"] == 0.0


def test_quantiles_read_their_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("cast(id as double) as v").mapInArrow(count, "v double")
    row = analysis.robust_statistics(df, "v", F.col("v") >= 0).first()
    assert (row["median"], row["value_count"], row["max"]) == (499.5, 1000, 999.0)
    assert sum(r["row_count"] for r in analysis.width_histogram(df, "v").collect()) == 1000
    assert reads.value == 2000


@pytest.mark.parametrize("n", [1, 7, 40, 10_000])
def test_smallest_rows_with_many_copies(spark, n):
    rows = [(1, "a")] * 30 + [(i % 5, chr(97 + i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, s string").repartition(4)
    found = analysis.smallest_rows(df, n, ["k", "s"], F.col("k")).collect()
    assert sorted(map(tuple, found)) == sorted(rows)[:n]


def test_hash_sample_is_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    first = {r["k"] for r in analysis.hash_sample(df.repartition(3), 200, ["k"]).collect()}
    again = {r["k"] for r in analysis.hash_sample(df.repartition(9), 200, ["k"]).collect()}
    assert first == again and len(first) == 200


def test_modal_label_takes_the_smallest_on_ties(spark):
    rows = [("c", HOUR, 1.0, 1.0, 5.0, 1, 0.5, 2), ("c", HOUR, 1.0, 1.0, 5.0, 1, 0.5, 1)]
    df = spark.createDataFrame(rows, """cell_id string, hour_bucket timestamp, cell_lat double,
        cell_lon double, avg_speed double, vehicle_count int, congestion_index double,
        congestion_label int""")
    assert aggregates.cell_statistics(df).first()["dominant_congestion_level"] == 1


def test_top_k_breaks_ties_by_cell(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "cell_id string, n int")
    top = analysis.top_k(df, 2, F.desc("n"), F.col("cell_id"))
    assert [(r["cell_id"], r["rank"]) for r in top.collect()] == [("c", 1), ("a", 2)]


def test_zone_matchers_agree_with_brute_force(spark):
    rng = random.Random(5)
    points = [(i, rng.uniform(40.69, 40.81), rng.uniform(-74.03, -73.94)) for i in range(400)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    expected = {
        i: next((n for n, a, o, r in profiles.LANDMARKS
                 if ((lat - a) ** 2 + (lon - o) ** 2) ** 0.5 < r), None)
        for i, lat, lon in points
    }
    literal = df.select("id", joins.landmark_name("latitude", "longitude").alias("zone_name"))
    by_table = joins.match_zones(df, joins.landmark_table(spark))
    salted = joins.match_zones(df.unionByName(df), joins.landmark_table(spark), broadcast_zones=0)
    assert salted.count() == 800
    for found in (literal, by_table, salted):
        assert {r["id"]: r["zone_name"] for r in found.collect()} == expected
    assert len(set(expected.values())) > 5


@pytest.mark.parametrize("broadcast_zones", [100_000, 0])
def test_crowded_tiles_are_cut(spark, broadcast_zones):
    """Thousands of zones in one tile, many of them equal or one above the other."""
    rng = random.Random(6)
    zones = [(i, f"z{i}", rng.gauss(40.71, 0.001), rng.gauss(-74.01, 0.001), rng.choice((1e-4, 3e-4, 0.01))) for i in range(800)]
    zones += [(1000 + i, f"y{i}", 40.72, -74.02, 0.0005) for i in range(800)]
    points = [(i, rng.gauss(40.71, 0.002), rng.gauss(-74.01, 0.002)) for i in range(300)] + [(300, 40.72, -74.02)]
    table = spark.createDataFrame(zones, "zone_order int, name string, lat double, lon double, radius double")
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    found = joins.match_zones(df, table, broadcast_zones=broadcast_zones, crowd=30)
    expected = {
        i: next((n for _, n, a, o, r in sorted(zones) if math.sqrt((lat - a) * (lat - a) + (lon - o) * (lon - o)) < r), None)
        for i, lat, lon in points
    }
    assert {r["id"]: r["zone_name"] for r in found.collect()} == expected
    tiles = joins.zone_tiles(table, 0.05, crowd=30)
    assert len(tiles) > 3 and max(t.agg(F.max(F.size("_zones"))).first()[0] or 0 for _, t in tiles) <= 30


def test_zone_lists_of_any_length(spark):
    far = [(f"far {i}", 50.0 + i, 0.0, 0.01) for i in range(300)]
    df = spark.createDataFrame([(profiles.LANDMARKS[0][1], profiles.LANDMARKS[0][2])], "a double, b double")
    found = df.select(joins.landmark_name("a", "b", [*far, *profiles.LANDMARKS])).first()[0]
    assert found == profiles.LANDMARKS[0][0]


def test_means_equal_plain_ones_and_pass_nan(spark):
    inf, nan = float("inf"), float("nan")
    for values in ([1.25, 2.5, 10.0], [nan, 10.0], [inf, 1.0], [inf, -inf], [None, 3.0], [None, None]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        ours, plain = df.agg(stable_avg("v"), F.avg("v")).first()
        assert str(ours) == str(plain) or ours == pytest.approx(plain, abs=1e-6)


def test_events_repeat_for_a_replayed_trip(spark):
    trips = views.clean(spark, SMALL)
    ids = lambda: {r["event_id"] for r in events.gps_events(trips).select("event_id").collect()}
    assert ids() == ids()


def test_unknown_cell_gives_no_row(spark):
    current = views.traffic_state(spark, SMALL)
    assert state.cell_details(current, "cell_999_999", F.current_timestamp()).count() == 0


def test_bridge_fills_missing_fields(spark):
    df = spark.createDataFrame(
        [("cell_1_2", None, None, None, None, None, None, None, HOUR), (None,) * 8 + (HOUR,)],
        """cell_id string, cell_lat int, cell_lon int, trip_count bigint, avg_speed double,
        max_speed double, min_speed double, congestion_level string, window_end timestamp""")
    rows = state.bridge_state(df).collect()
    assert len(rows) == 1
    assert (rows[0]["congestion_index"], rows[0]["avg_speed"], rows[0]["vehicle_count"]) == (
        0.55, 20.0, 0)


def test_confidence_formula(spark):
    raw = spark.createDataFrame([([1.0, 2.0, 50.0],)], "r array<double>")
    import math
    weights = [math.exp(min(v, 10.0)) for v in (1.0, 2.0, 50.0)]
    found = raw.select(ml.confidence_from_raw(F.col("r"))).first()[0]
    assert found == pytest.approx(max(weights) / sum(weights))


def test_split_by_date_refuses_an_empty_side(spark):
    rows = views.feature_rows(spark, SMALL)
    with pytest.raises(ValueError, match="hash_split"):
        features.temporal_split(rows.filter("month = 1"))
    _, test = features.temporal_split(rows)
    assert {r[0] for r in test.select("month").distinct().collect()} == {3}


def test_hash_split_does_not_depend_on_partitions(spark):
    rows = views.feature_rows(spark, SMALL).select("cell_id", "hour_bucket")
    keys = lambda df: {tuple(r) for r in df.collect()}
    one = [keys(side) for side in features.hash_split(rows.repartition(3))]
    again = [keys(side) for side in features.hash_split(rows.repartition(11))]
    assert one == again and not one[0] & one[1] and len(one[0] | one[1]) == rows.count()
    assert 0.77 < len(one[0]) / rows.count() < 0.83


def test_model_metrics_and_reload(spark, tmp_path):
    path = str(tmp_path / "features")
    sinks.write_parquet(views.feature_rows(spark, SMALL), path)
    train, test = features.temporal_split(spark.read.parquet(path))
    fitted = ml.fit("rf", train, numTrees=10, maxDepth=6)
    counts = ml.outcome_counts(fitted.model.transform(test))
    assert sum(r["n"] for r in counts.collect()) == test.count()
    found = ml.outcomes(fitted, train, test)
    evaluation = ml.evaluation(fitted, found)
    majority = max(r["count"] for r in test.groupBy("congestion_label").count().collect())
    assert evaluation.first()["test_accuracy"] > 0.95 * majority / test.count()
    ml.save(fitted, found, str(tmp_path / "model"))
    again = ml.outcome_counts(ml.load(str(tmp_path / "model")).transform(test))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, counts.collect()))
    info = sinks.read_json_record(spark, str(tmp_path / "model" / "info"))
    assert len(info["feature_importance"]) == 16


def test_one_failing_fit_does_not_stop_the_next(spark):
    fits = ml.fit_all(
        views.feature_rows(spark, SMALL), ("lr", "rf"),
        lr={"regParam": -1.0}, rf={"numTrees": 2, "maxDepth": 2},
    )
    assert [f.model is not None for f in fits] == [False, True] and fits[0].error


def test_sketches_of_hours_add_up(spark):
    """Tens of thousands of cells, most of them in several hours: within three standard errors."""
    rng = random.Random(7)
    rows = [(HOUR + dt.timedelta(minutes=rng.randrange(72 * 60)), f"c{rng.randrange(40_000)}", 10.0) for _ in range(60_000)]
    trips = spark.createDataFrame(rows, "pickup_datetime timestamp, cell_id string, speed_mph double")
    hours = rollups.hourly(trips).cache()
    start, end = HOUR + dt.timedelta(hours=5), HOUR + dt.timedelta(hours=60)
    found = rollups.span(hours, start, end).first()
    inside = [r for r in rows if start <= r[0] < end]
    assert found["trip_count"] == len(inside) and found["avg_speed"] == 10.0
    exact = len({r[1] for r in inside})
    assert abs(found["cells"] - exact) <= 3 * 0.0082 * exact
    assert rollups.span(hours, end + dt.timedelta(days=9), end + dt.timedelta(days=10)).first()["cells"] == 0
