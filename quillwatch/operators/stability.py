"""Stability labels, classifiers and their evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import UNSTABLE_ABOVE, stability_label
from quillwatch.operators.charts import score_counts
from quillwatch.operators.sequences import median_of, running_totals

# The numeric features in vector order; the topic index comes last.
NUMERIC_FEATURES = (
    "edit_velocity", "unique_editors", "editor_diversity", "avg_content_change",
    "avg_daily_views", "pageview_spike_ratio", "claims_count", "sitelinks_count",
    "total_edits",
)
FEATURES = (*NUMERIC_FEATURES, "topic_index")

# Share of articles held out, seed, and the settings of the two classifiers.
TEST_SHARE = 0.2
SEED = 42
FOREST = {"numTrees": 100, "maxDepth": 8, "seed": SEED}
REGRESSION = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}

ROWS_PER_TRAINING_TASK = 50_000


def with_label(features: DataFrame, above: float = UNSTABLE_ABOVE) -> DataFrame:
    return features.withColumn("stability_label", stability_label("reversion_rate", above))


def with_median_label(features: DataFrame) -> DataFrame:
    """Label against the median reversion rate instead of the fixed threshold."""
    threshold = median_of(features, "reversion_rate").scalar()
    return features.withColumn("stability_label", stability_label("reversion_rate", threshold))


def label_distribution(labelled: DataFrame, above: float = UNSTABLE_ABOVE) -> DataFrame:
    return labelled.agg(
        F.count_if(F.col("stability_label") == 0.0).alias("stable"),
        F.count_if(F.col("stability_label") == 1.0).alias("unstable"),
    ).withColumn("threshold", F.lit(above))


def filled(labelled: DataFrame) -> DataFrame:
    return labelled.fillna({name: 0 for name in NUMERIC_FEATURES})


def topic_indexer() -> StringIndexer:
    """Most frequent topic first, equal counts by name; unseen topics get an index of their own."""
    return StringIndexer(
        inputCol="topic_category",
        outputCol="topic_index",
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )


def feature_stages(labelled: DataFrame) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return Pipeline(stages=[topic_indexer(), assembler]).fit(filled(labelled))


def feature_vectors(labelled: DataFrame) -> DataFrame:
    return feature_stages(labelled).transform(filled(labelled))


def with_split(rows: DataFrame, key: str = "article_title", test_share: float = TEST_SHARE) -> DataFrame:
    """Add ``part``, train or test, from a hash of the key: the split does not depend on how
    rows are partitioned or on recomputation."""
    percent = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint") % 100
    train = F.lit(round((1.0 - test_share) * 100))
    return rows.withColumn("part", F.when(percent < train, "train").otherwise("test"))


def train_test_split(rows: DataFrame, **split) -> tuple[DataFrame, DataFrame]:
    parted = with_split(rows, **split)
    side = lambda name: parted.filter(F.col("part") == name).drop("part")
    return side("train"), side("test")


def in_fixed_order(rows: DataFrame, key: str = "article_title") -> DataFrame:
    """Rows placed and ordered by their key alone, in as many tasks as their number asks for.
    The forest draws its samples per partition in row order, so a fit comes out the same
    however the table was stored or recomputed."""
    tasks = rows.count() // ROWS_PER_TRAINING_TASK + 1
    return rows.repartition(tasks, key).sortWithinPartitions(key)


def fit_forest(train: DataFrame):
    forest = RandomForestClassifier(labelCol="stability_label", featuresCol="features", **FOREST)
    return forest.fit(in_fixed_order(train))


def fit_regression(train: DataFrame):
    regression = LogisticRegression(labelCol="stability_label", featuresCol="features", **REGRESSION)
    return regression.fit(in_fixed_order(train))


def predictions_of(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select(
        "article_title", "stability_label", "prediction", "rawPrediction", "probability"
    )


def evaluate(predictions: DataFrame) -> dict[str, float]:
    """Accuracy, area under the ROC curve (exact: no score binning) and label-weighted F1."""
    multi = MulticlassClassificationEvaluator(labelCol="stability_label", predictionCol="prediction")
    binary = BinaryClassificationEvaluator(
        labelCol="stability_label", rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
    )
    return {
        "accuracy": multi.setMetricName("accuracy").evaluate(predictions),
        "auc": binary.evaluate(predictions),
        "f1": multi.setMetricName("f1").evaluate(predictions),
    }


def area_under_roc(scored: DataFrame, score: str = "score", label: str = "stability_label") -> DataFrame:
    """Share of (positive, negative) pairs that the score puts in order, ties counting half,
    from counts per distinct score."""
    below = running_totals(score_counts(scored, score, label), "score", ["neg"])
    won = F.col("pos").cast("double") * (F.col("below_neg") + F.col("neg") / 2)
    counts = below.agg(
        F.sum(won).alias("won"),
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
    )
    return counts.select(F.try_divide(F.col("won"), F.col("p") * F.col("n")).alias("auc"))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("stability_label", "prediction")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("stability_label", "prediction")
    )


def accuracy_and_f1(predictions: DataFrame) -> DataFrame:
    """Both from the confusion counts, in one pass over the predictions."""
    is_pos, says_pos = F.col("stability_label") == 1.0, F.col("prediction") == 1.0
    cells = predictions.agg(
        F.count_if(is_pos & says_pos).alias("tp"),
        F.count_if(~is_pos & says_pos).alias("fp"),
        F.count_if(is_pos & ~says_pos).alias("fn"),
        F.count_if(~is_pos & ~says_pos).alias("tn"),
    )
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    f1 = lambda hit, a, b: F.coalesce(F.try_divide(2.0 * hit, 2.0 * hit + a + b), F.lit(0.0))
    weighted = (F.col("tp") + F.col("fn")) * f1(F.col("tp"), F.col("fp"), F.col("fn")) + (
        F.col("tn") + F.col("fp")
    ) * f1(F.col("tn"), F.col("fn"), F.col("fp"))
    return cells.select(
        F.try_divide(F.col("tp") + F.col("tn"), n).alias("accuracy"), F.try_divide(weighted, n).alias("f1")
    )


def feature_importance(forest, spark) -> DataFrame:
    """Ten rows, most important feature first; equal importance by name."""
    rows = sorted(
        zip(FEATURES, map(float, forest.featureImportances.toArray())), key=lambda r: (-r[1], r[0])
    )
    return spark.createDataFrame(
        [(i + 1, name, value) for i, (name, value) in enumerate(rows)],
        "rank INT, feature STRING, importance DOUBLE",
    )


def model_metrics(metrics: dict[str, dict[str, float]], importance: DataFrame) -> DataFrame:
    """One row per model with its scores; every row carries the ranked importances."""
    spark = importance.sparkSession
    scores = spark.createDataFrame(
        [(name, m["accuracy"], m["auc"], m["f1"]) for name, m in metrics.items()],
        "model STRING, accuracy DOUBLE, auc DOUBLE, f1 DOUBLE",
    )
    ranked = F.array_sort(F.collect_list(F.struct("rank", "feature", "importance")))
    ranking = importance.agg(
        F.transform(
            ranked, lambda r: F.struct(r["feature"].alias("feature"), r["importance"].alias("importance"))
        ).alias("ranking")
    )
    return scores.select("*", ranking.scalar().alias("feature_importance"))


def predictions_union(by_model: dict[str, DataFrame]) -> DataFrame:
    """All models' predictions in one table, probabilities as plain arrays."""
    tagged = [
        p.select(
            F.lit(name).alias("model"),
            "article_title",
            "stability_label",
            "prediction",
            vector_to_array("probability").alias("probability"),
        )
        for name, p in by_model.items()
    ]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out
