"""Model training and scoring queries; iterative, so checked by rows and by tests."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.operators import features, ml, state
from tripgrid.plans import jobs, views
from tripgrid.plans.registry import query
from tripgrid.plans.state_queries import as_of
from tripgrid.plans.streaming_queries import gps_stream
from tripgrid.plans.views import sql_from
from tripgrid.session import scratch_dir
from tripgrid.sources import files, sinks
from tripgrid.streaming import enrich

# Fits of this process, by session and state of the input: several queries look at the same model,
# and the boosting one takes minutes. Every fit has the published parameters.
_FITTED: dict[tuple, ml.Fit] = {}


def _stamp(spark, d) -> tuple[int, int]:
    """Size and time of the trips' table, so that changed data is fitted anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{d}/lineitem.parquet")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(path).getLength(), system.getFileStatus(path).getModificationTime()


def _split(spark, rows):
    path = scratch_dir(spark, "features")
    sinks.write_parquet(rows, path)
    return features.temporal_split(files.read_features(spark, path)[0])


def split(spark, d):
    """Train and test rows from a stored feature table, so that fits do not rebuild it."""
    return _split(spark, views.feature_rows(spark, d))


def fitted(spark, d, kind: str, train=None) -> ml.Fit:
    key = (spark.sparkContext.applicationId, d, kind, _stamp(spark, d))
    if key not in _FITTED:
        rows = split(spark, d)[0] if train is None else train() if callable(train) else train
        found = ml.fit(kind, rows)
        if found.error:
            raise RuntimeError(found.error)
        _FITTED[key] = found
    return _FITTED[key]


def snapshot_and_model(spark, d, path):
    """Writes the history snapshot to ``path`` and gives the logistic model: one pass over the trips for both.

    The cell hours are stored, as snapshot and features ask for them three times. Features are
    made for a model that is not fitted yet only.
    """
    stored = scratch_dir(spark, "cells")
    sinks.write_parquet(views.labelled(spark, d), stored)
    cells = spark.read.parquet(stored)
    sinks.write_parquet(enrich.history_snapshot(cells), path)
    return fitted(spark, d, "lr", lambda: _split(spark, features.feature_table(cells))[0]).model


_SCALED_SQL = "\nUNION ALL ".join(
    f"""SELECT '{n}' AS feature, count(*) AS rows, 0.0::DOUBLE AS mean,
  CASE WHEN count(DISTINCT {n}) > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS deviation
FROM features""" for n in profiles.FEATURE_COLUMNS)


@query("m04_scaled_features", sql_from("features", _SCALED_SQL))
def m04(spark, d):
    """Every scaled feature has mean 0 and deviation 1 (0 if it never changes)."""
    rows = views.feature_rows(spark, d)
    scaled = Pipeline(stages=ml.feature_stages()).fit(rows).transform(rows)
    values = vector_to_array("features")
    long = scaled.select(F.posexplode(values).alias("i", "v"))
    names = F.array(*[F.lit(n) for n in profiles.FEATURE_COLUMNS])
    return long.groupBy(F.get(names, F.col("i")).alias("feature")).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.round(F.avg("v"), 6) + 0.0).alias("mean"),
        F.round(F.stddev_samp("v"), 6).alias("deviation"),
    )


def _evaluated(kind):
    def build(spark, d):
        train, test = split(spark, d)
        return ml.evaluate(fitted(spark, d, kind, train), train, test)
    return build


query("m05_random_forest")(_evaluated("rf"))
query("m06_boosted_trees")(_evaluated("gbt"))
query("m07_logistic")(_evaluated("lr"))


@query("m08_fit_all", """
SELECT * FROM (VALUES ('rf', true, false), ('gbt', false, true), ('lr', true, false))
  t(model, fitted, failed) WHERE (SELECT count(*) FROM lineitem) > 0""")
def m08(spark, d):
    """All three classifiers with their outcome; one with a bad parameter fails alone."""
    train, _ = split(spark, d)
    fits = ml.fit_all(train, gbt={"stepSize": -1.0})
    rows = [(f.kind, f.model is not None, f.error is not None) for f in fits]
    return spark.createDataFrame(rows, "model string, fitted boolean, failed boolean")


@query("m10_feature_importance")
def m10(spark, d):
    """Importances of the forest and, averaged over its members, of the one-vs-rest model."""
    train, _ = split(spark, d)
    ranked = [
        ml.feature_importance(spark, fitted(spark, d, kind, train).model).withColumn("model", F.lit(kind))
        for kind in ("rf", "gbt")
    ]
    return ranked[0].unionByName(ranked[1])


@query("m11_model_comparison")
def m11(spark, d):
    train, test = split(spark, d)
    fits = [fitted(spark, d, kind, train) for kind in ("rf", "gbt", "lr")]
    return ml.compare([ml.evaluate(f, train, test) for f in fits])


_SPLIT_SQL = """
SELECT cell_id, hour_bucket, CASE WHEN ('0x' || md5(cell_id || '|' ||
    strftime(hour_bucket, '%Y-%m-%d %H:%M:%S'))[1:8])::BIGINT < 3435973836 THEN 'first'
  ELSE 'second' END AS side FROM features"""


@query("o06_hash_split", sql_from("features", _SPLIT_SQL))
def o06(spark, d):
    """Both sides of the split by key hash; together every row, once."""
    sides = features.hash_split(views.feature_rows(spark, d))
    named = [s.select("cell_id", "hour_bucket", F.lit(n).alias("side")) for s, n in zip(sides, ("first", "second"))]
    return named[0].unionByName(named[1])


@query("m12_batch_scoring")
def m12(spark, d):
    """Every cell of the state scored at one moment by a trained model."""
    train, _ = split(spark, d)
    rows = state.scoring_rows(views.traffic_state(spark, d), as_of())
    return ml.score(fitted(spark, d, "lr", train).model, rows).select(
        "cell_id", "prediction", "predicted_level", "confidence", "model_used"
    )


def _agreeing(scored, formula, key):
    """Rows scored, and those that the written-out formula gives the same class and confidence."""
    other = formula.select(key, F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    same = (F.col("prediction") == F.col("p")) & (F.abs(F.col("confidence") - F.col("c")) < 0.0015)
    return scored.join(other, key).agg(F.count(F.lit(1)).alias("scored"), F.count_if(same).alias("same_by_formula"))


@query("m12_scores_by_formula", sql_from("state", """
SELECT count(*) AS scored, count(*) AS same_by_formula FROM state"""))
def m12_formula(spark, d):
    """Scores of the library against the model's numbers put into plain arithmetic."""
    train, _ = split(spark, d)
    model = fitted(spark, d, "lr", train).model
    rows = state.scoring_rows(views.traffic_state(spark, d), as_of())
    return _agreeing(ml.score(model, rows), ml.formula_scores(model, rows), "cell_id")


@query("r06_event_scores_by_formula", sql_from("gps", """
SELECT count(*) AS scored, count(*) AS same_by_formula FROM gps"""))
def r06_formula(spark, d):
    """The same for events joined with their cells' history."""
    path = scratch_dir(spark, "snapshot")
    model = snapshot_and_model(spark, d, path)
    enriched = enrich.enrich_events(views.gps(spark, d), spark.read.parquet(path))
    # events have no unique key, so each row carries both results
    scored = ml.score(model, enriched).select(*enriched.columns, F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    both = ml.formula_scores(model, scored)
    same = (F.col("prediction") == F.col("p")) & (F.abs(F.col("confidence") - F.col("c")) < 0.0015)
    return both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(same).alias("same_by_formula"))


@query("r06_model_scored_events")
def r06_model(spark, d):
    """Events enriched with cell history and scored by a trained model."""
    path = scratch_dir(spark, "snapshot")
    return _scored_events(spark, d, path, snapshot_and_model(spark, d, path))


def _scored_events(spark, d, snapshot, model):
    enriched = enrich.enrich_events(views.gps(spark, d), spark.read.parquet(snapshot))
    return ml.score(model, enriched).select(
        "event_id", "cell_id", "prediction", "predicted_level", "confidence"
    )


@query("r06_model_scored_events_stream", sql_from("gps", """
SELECT count(*) AS events, count(*) AS same_as_batch FROM gps"""))
def r06_stream(spark, d):
    """The stream command with a stored model: events and those scored as the batch form does."""
    folder = scratch_dir(spark, "stream")
    model = snapshot_and_model(spark, d, f"{folder}/snapshot")
    model.write().overwrite().save(f"{folder}/model/model")
    jobs.run_stream(
        spark, gps_stream(spark, d), folder, f"{folder}/snapshot", f"{folder}/model",
        ("raw", "scores"), {"raw": None, "scores": None},
    )
    columns = ["event_id", "cell_id", "prediction", "predicted_level", "confidence"]
    scored = spark.read.parquet(f"{folder}/scores").select(*columns)
    same = scored.join(_scored_events(spark, d, f"{folder}/snapshot", model), columns, "left_semi")
    return scored.agg(F.count(F.lit(1)).alias("events")).select(
        "events", same.agg(F.count(F.lit(1))).scalar().alias("same_as_batch")
    )


@query("m12_stored_scoring", sql_from("state", """
SELECT count(*) AS cells, count(*) AS same_as_fitted FROM state"""))
def m12_stored(spark, d):
    """The score command: a stored table scored by a stored model."""
    folder = scratch_dir(spark, "scoring")
    train, _ = split(spark, d)
    model = fitted(spark, d, "lr", train).model
    model.write().overwrite().save(f"{folder}/model/model")
    rows = state.scoring_rows(views.traffic_state(spark, d), as_of())
    sinks.write_parquet(rows, f"{folder}/rows")
    jobs.run_scoring(spark, f"{folder}/rows", f"{folder}/model", f"{folder}/scores")
    columns = ["cell_id", "prediction", "confidence"]
    scored = spark.read.parquet(f"{folder}/scores").select(*columns)
    same = scored.join(ml.score(model, rows).select(*columns), columns, "left_semi")
    return scored.agg(F.count(F.lit(1)).alias("cells")).select(
        "cells", same.agg(F.count(F.lit(1))).scalar().alias("same_as_fitted")
    )


@query("k11_stored_model", sql_from("features", """
SELECT count(*) AS rows, 0::BIGINT AS differing, 'lr' AS model FROM features
WHERE dataset_split = 'test'"""))
def k11(spark, d):
    """A stored model and its metadata, read back; both models count every outcome alike."""
    path = scratch_dir(spark, "model")
    train, test = split(spark, d)
    one = fitted(spark, d, "lr", train)
    found = ml.outcomes(one, train, test)
    ml.save(one, found, path)
    again = ml.outcome_counts(ml.load(path).transform(test))
    info = sinks.read_json_record(spark, f"{path}/info")
    both = found["test"].withColumnRenamed("n", "before").join(
        again.withColumnRenamed("n", "after"), ["label", "prediction"], "full"
    )
    return both.agg(
        F.sum("after").alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing"),
        F.lit(info["model"]).alias("model"),
    )
