"""Scores against the models' own numbers, put together by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripgrid import profiles
from tripgrid.operators import features, ml
from tripgrid.plans import ml_queries, views
from tripgrid.sources import fixtures


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "t")
    views.feature_rows(spark, SMALL).write.parquet(path)
    return features.temporal_split(spark.read.parquet(path))


def scaled(model, row):
    scaler = model.stages[1]
    return [
        (row[c] - m) * (1 / d if d else 0.0)
        for c, m, d in zip(profiles.FEATURE_COLUMNS, scaler.mean.toArray(), scaler.std.toArray())
    ]


def test_logistic_scores_by_hand(spark, sides):
    train, test = sides
    model = ml.fit("lr", train).model
    few = test.orderBy("cell_id", "hour_bucket").limit(50)
    logistic = model.stages[2]
    weights, intercepts = logistic.coefficientMatrix.toArray(), logistic.interceptVector.toArray()
    for row in ml.score(model, few).collect():
        x = scaled(model, row)
        margins = [sum(a * b for a, b in zip(x, w)) + b0 for w, b0 in zip(weights, intercepts)]
        shares = [math.exp(m - max(margins)) for m in margins]
        assert row["prediction"] == margins.index(max(margins))
        assert row["confidence"] == pytest.approx(max(shares) / sum(shares), abs=0.0006)
    every = ml.formula_scores(model, ml.score(model, test).withColumnsRenamed({"prediction": "p", "confidence": "c"}).drop("predicted_level"))
    assert every.filter((F.col("p") != F.col("prediction")) | (F.abs(F.col("c") - F.col("confidence")) > 0.0011)).count() == 0


def test_forest_scores_by_hand(spark, sides, tmp_path):
    """Every tree of the stored forest walked from its saved nodes."""
    train, test = sides
    model = ml.fit("rf", train, numTrees=7, maxDepth=5).model
    forest = model.stages[2]
    forest.write().save(str(tmp_path / "rf"))
    nodes = {}
    for r in spark.read.parquet(str(tmp_path / "rf/data")).collect():
        data = r["nodeData"]
        nodes[r["treeID"], data["id"]] = data

    def leaf(tree, x):
        node = nodes[tree, 0]
        while node["leftChild"] >= 0:
            split = node["split"]
            goes_left = x[split["featureIndex"]] <= split["leftCategoriesOrThreshold"][0]
            node = nodes[tree, node["leftChild"] if goes_left else node["rightChild"]]
        return node["impurityStats"]

    for row in ml.score(model, test.orderBy("cell_id", "hour_bucket").limit(60)).collect():
        x = scaled(model, row)
        votes = [0.0] * 3
        for tree in range(7):
            stats = leaf(tree, x)
            votes = [v + s / sum(stats) for v, s in zip(votes, stats)]
        assert row["prediction"] == votes.index(max(votes))
        assert row["confidence"] == pytest.approx(max(votes) / 7, abs=0.0006)


def test_scored_stream_passes_the_trips_once_for_history_and_model(spark, monkeypatch):
    """The other pass is the batch form's own; the stream reads the file itself."""
    passes, made = [], fixtures.typed_trips
    monkeypatch.setattr(fixtures, "typed_trips", lambda *args: passes.append(args) or made(*args))
    row = ml_queries.r06_stream(spark, SMALL).first()
    assert row["events"] == row["same_as_batch"] > 0
    assert len(passes) == 2
