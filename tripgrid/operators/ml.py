"""Training, evaluation and scoring with MLlib pipelines."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import labels
from tripgrid.sources.sinks import write_json_record

LABEL = "congestion_label"
CLASSES = (0, 1, 2)
DEFAULT_CONFIDENCE = 0.80

# published training parameters
FOREST = {
    "numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 10,
    "featureSubsetStrategy": "sqrt", "seed": 42,
}
BOOSTED = {"maxIter": 50, "maxDepth": 8, "stepSize": 0.1, "seed": 42}
LOGISTIC = {
    "maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5, "family": "multinomial",
}
TITLES = {
    "rf": "Random Forest", "gbt": "Gradient Boosted Trees", "lr": "Logistic Regression",
}


def feature_stages(columns=profiles.FEATURE_COLUMNS) -> list:
    """Assemble (rows with missing inputs are skipped), then centre and scale."""
    return [
        VectorAssembler(
            inputCols=list(columns), outputCol="features_raw", handleInvalid="skip"
        ),
        StandardScaler(
            inputCol="features_raw", outputCol="features", withMean=True, withStd=True
        ),
    ]


def classifier(kind: str, **overrides):
    """``rf``, ``gbt`` (one-vs-rest, as boosting is binary) or ``lr``."""
    shared = {"featuresCol": "features", "labelCol": LABEL}
    if kind == "rf":
        return RandomForestClassifier(**shared, **{**FOREST, **overrides})
    if kind == "gbt":
        base = GBTClassifier(**shared, **{**BOOSTED, **overrides})
        return OneVsRest(**shared, classifier=base)
    if kind == "lr":
        return LogisticRegression(**shared, **{**LOGISTIC, **overrides})
    raise ValueError(f"unknown classifier {kind!r}")


def pipeline(kind: str, columns=profiles.FEATURE_COLUMNS, **overrides) -> Pipeline:
    return Pipeline(stages=[*feature_stages(columns), classifier(kind, **overrides)])


@dataclass
class Fit:
    kind: str
    model: PipelineModel | None
    seconds: float
    error: str | None = None


def fit(kind: str, train: DataFrame, **overrides) -> Fit:
    """Fit one pipeline and time it; an error is kept with the result, not raised."""
    start = time.perf_counter()
    try:
        model, error = pipeline(kind, **overrides).fit(train), None
    except Exception as failure:  # one failing classifier must not stop the others
        model, error = None, f"{type(failure).__name__}: {failure}"
    return Fit(kind, model, round(time.perf_counter() - start, 1), error)


def fit_all(train: DataFrame, kinds=("rf", "gbt", "lr"), **overrides) -> list[Fit]:
    """Fit several pipelines over one stored copy of the training rows.

    ``overrides`` maps a kind to its changed parameters. The copy may spill to disk.
    """
    stored = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [fit(kind, stored, **overrides.get(kind, {})) for kind in kinds]
    finally:
        stored.unpersist()


# ---- evaluation, all from one pass of at most nine (label, prediction) counts -----------


def outcome_counts(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """One row per true label with the count of each predicted class."""
    return counts.groupBy("label").agg(*[
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0))
        .alias(f"predicted_{c}")
        for c in CLASSES
    ])


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, 0 where undefined."""
    expanded = counts.select(
        "n", "label", "prediction",
        F.explode(F.array(*[F.lit(c) for c in CLASSES])).alias("class"),
    )
    truth, guess = F.col("label") == F.col("class"), F.col("prediction") == F.col("class")
    rows_where = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    sums = expanded.groupBy("class").agg(
        rows_where(truth & guess).alias("tp"),
        rows_where(~truth & guess).alias("fp"),
        rows_where(truth).alias("support"),
    )
    rates = sums.select(
        "class",
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        "support",
    )
    f1 = _ratio(
        F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
    )
    return rates.withColumn("f1", f1).withColumn("level", labels.level_name("class"))


def weighted_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 as one row."""
    hits = counts.agg(
        _ratio(
            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)),
            F.sum("n"),
        ).alias("a")
    ).scalar()
    weighted = lambda name: _ratio(
        F.sum(F.col(name) * F.col("support")), F.sum("support")
    ).alias(f"weighted_{name}")
    return class_report(counts).agg(
        hits.alias("accuracy"), weighted("precision"), weighted("recall"), weighted("f1")
    )


def feature_importance(
    spark: SparkSession, model: PipelineModel, columns=profiles.FEATURE_COLUMNS
) -> DataFrame | None:
    """Ranked importances; one-vs-rest averages its members; None for models without any."""
    last = model.stages[-1]
    members = [m for m in getattr(last, "models", [last]) if hasattr(m, "featureImportances")]
    if not members:
        return None
    means = sum(m.featureImportances.toArray() for m in members) / len(members)
    ranked = sorted(zip(columns, map(float, means)), key=lambda pair: (-pair[1], pair[0]))
    rows = [(rank, name, value) for rank, (name, value) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def outcomes(fitted: Fit, train: DataFrame, test: DataFrame) -> dict[str, DataFrame]:
    """Outcome counts of both sides, each scored once and kept as at most nine rows."""
    found = {}
    for side, rows in (("train", train), ("test", test)):
        counts = outcome_counts(fitted.model.transform(rows))
        found[side] = counts.sparkSession.createDataFrame(counts.collect(), counts.schema)
    return found


def evaluation(fitted: Fit, counts: dict[str, DataFrame]) -> DataFrame:
    """One row: model, test metrics, train accuracy and training seconds."""
    on_test, on_train = weighted_metrics(counts["test"]), weighted_metrics(counts["train"])
    return on_test.select(
        F.lit(fitted.kind).alias("model"),
        F.lit(TITLES[fitted.kind]).alias("title"),
        F.col("accuracy").alias("test_accuracy"),
        F.col("weighted_precision").alias("test_precision"),
        F.col("weighted_recall").alias("test_recall"),
        F.col("weighted_f1").alias("test_f1"),
        on_train.select("accuracy").scalar().alias("train_accuracy"),
        F.lit(fitted.seconds).alias("training_seconds"),
    )


def evaluate(fitted: Fit, train: DataFrame, test: DataFrame) -> DataFrame:
    return evaluation(fitted, outcomes(fitted, train, test))


def compare(evaluations: list[DataFrame]) -> DataFrame:
    """All evaluations, the model with the highest test F1 marked as best."""
    table = evaluations[0]
    for other in evaluations[1:]:
        table = table.unionByName(other)
    best = table.agg(F.max_by("model", "test_f1")).scalar()
    return table.withColumn("best", F.col("model") == best)


# ---- scoring ------------------------------------------------------------------------------


def confidence_from_raw(raw: Column) -> Column:
    """Largest share of exp(min(score, 10)) over an array of raw class scores."""
    weights = F.transform(raw, lambda v: F.exp(F.least(v, F.lit(10.0))))
    total = F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)
    share = F.when(total > 0, F.array_max(weights) / total)
    return F.coalesce(share, F.lit(DEFAULT_CONFIDENCE))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with prediction, level and confidence; the model's vector columns are dropped."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        confidence = F.array_max(vector_to_array("probability"))
    elif "rawPrediction" in scored.columns:
        confidence = confidence_from_raw(vector_to_array("rawPrediction"))
    else:
        confidence = F.lit(DEFAULT_CONFIDENCE)
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        labels.level_name("prediction").alias("predicted_level"),
        F.round(confidence, 3).alias("confidence"),
        F.lit("spark-mllib").alias("model_used"),
    )


def formula_scores(model: PipelineModel, df: DataFrame) -> DataFrame:
    """What ``score`` gives for a logistic model, written out from its numbers.

    Plain column arithmetic on the means, deviations, weights and intercepts: an independent check
    of stored models, and a way to score in one stage without vectors. Rows with a missing input
    are skipped, as in the pipeline.
    """
    assembler, scaler, logistic = model.stages
    inputs = assembler.getInputCols()
    scale = [1.0 / d if d else 0.0 for d in scaler.std.toArray()]
    scaled = [(F.col(c) - float(m)) * float(k) for c, m, k in zip(inputs, scaler.mean.toArray(), scale)]
    weights, intercepts = logistic.coefficientMatrix.toArray(), logistic.interceptVector.toArray()
    margins = [
        reduce(lambda a, b: a + b, [x * float(w) for x, w in zip(scaled, row) if w], F.lit(float(b)))
        for row, b in zip(weights, intercepts)
    ]
    if len(margins) == 1:  # two classes have one row of weights
        margins = [F.lit(0.0), margins[0]]
    named = df.na.drop(subset=list(inputs)).withColumn("_margins", F.array(*margins))
    largest = F.array_max("_margins")
    total = F.aggregate("_margins", F.lit(0.0), lambda s, m: s + F.exp(m - largest))
    prediction = (F.array_position("_margins", largest) - 1).cast("int")
    return named.select(
        *df.columns, prediction.alias("prediction"), labels.level_name(prediction).alias("predicted_level"),
        F.round(1.0 / total, 3).alias("confidence"),
    )


# ---- storage ------------------------------------------------------------------------------


def save(fitted: Fit, found: dict[str, DataFrame], path: str) -> None:
    """Model below ``path/model`` and its metadata record below ``path/info``.

    ``found`` are the outcome counts of both sides, so nothing is scored again.

    Only bounded tables reach the driver: one metric row, three class rows, the importances.
    """
    counts = found["test"]
    spark = counts.sparkSession
    fitted.model.write().overwrite().save(f"{path}/model")
    importance = feature_importance(spark, fitted.model)
    rows = lambda df: [row.asDict() for row in df.collect()]
    record = {
        "model": fitted.kind,
        "title": TITLES[fitted.kind],
        "features": list(profiles.FEATURE_COLUMNS),
        "classes": list(profiles.LABELS.names),
        "metrics": rows(evaluation(fitted, found))[0],
        "confusion_matrix": rows(confusion_matrix(counts)),
        "class_report": rows(class_report(counts)),
        "feature_importance": rows(importance) if importance is not None else [],
    }
    write_json_record(spark, record, f"{path}/info")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
