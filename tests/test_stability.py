import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quillwatch.operators import charts, stability


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        rate = rng.random() * 0.3
        rows.append((f"A{i}", rng.choice(["political", "cultural", "unknown"]), rate, rate * 10 + rng.random(), rng.randrange(50), None if i % 9 == 0 else rng.random()))
    df = spark.createDataFrame(
        rows,
        "article_title STRING, topic_category STRING, reversion_rate DOUBLE, edit_velocity DOUBLE, unique_editors BIGINT, editor_diversity DOUBLE",
    )
    rest = set(stability.NUMERIC_FEATURES) - set(df.columns)
    return stability.with_label(df.withColumns({name: F.lit(1.0) for name in rest})).cache()


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = [(i, round(rng.random(), 2), float(rng.random() < 0.4)) for i in range(800)]
    df = spark.createDataFrame(rows, "event_id BIGINT, score DOUBLE, stability_label DOUBLE")
    return df.withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0)).cache()


def test_labels_against_median(table):
    assert table.count() == 300
    labelled = stability.with_median_label(table)
    assert labelled.filter("stability_label = 1.0").count() == 150
    d = stability.label_distribution(table).first()
    assert d.stable + d.unstable == 300 and d.threshold == 0.15


def test_split_is_stable_and_complete(table):
    train, test = stability.train_test_split(table)
    again, _ = stability.train_test_split(table.repartition(11))
    names = lambda df: {r.article_title for r in df.select("article_title").collect()}
    assert names(train) == names(again)
    assert names(train) | names(test) == names(table) and not names(train) & names(test)
    assert 0.7 < train.count() / 300 < 0.9


def test_topic_index_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "topic_category STRING")
    got = stability.topic_indexer().fit(df).transform(df).distinct().collect()
    assert {r.topic_category: r.topic_index for r in got} == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_vectors_hold_ten_features(table):
    rows = stability.feature_vectors(table).select("features", "unique_editors", "editor_diversity").collect()
    assert all(len(r.features) == 10 for r in rows)
    assert all(r.features[1] == r.unique_editors for r in rows)
    assert any(r.editor_diversity == 0 for r in rows)  # filled, not dropped
    assert len(rows) == 300


def test_models_predict_and_report(spark, table):
    train, test = stability.train_test_split(stability.feature_vectors(table).cache())
    forest, regression = stability.fit_forest(train), stability.fit_regression(train)
    assert forest.getNumTrees == 100
    predictions = {"RandomForest": stability.predictions_of(forest, test), "LogisticRegression": stability.predictions_of(regression, test)}
    scores = {name: stability.evaluate(p) for name, p in predictions.items()}
    assert all(0.6 < s["auc"] <= 1 for s in scores.values())
    importance = stability.feature_importance(forest, spark).collect()
    assert [r.rank for r in importance] == list(range(1, 11)) and importance[0].feature == "edit_velocity"
    metrics = {r.model: r for r in stability.model_metrics(scores, stability.feature_importance(forest, spark)).collect()}
    assert set(metrics) == set(scores)
    assert metrics["RandomForest"].feature_importance[0].feature == "edit_velocity"
    union = stability.predictions_union(predictions)
    assert union.count() == 2 * test.count()
    assert all(sum(r.probability) == pytest.approx(1) for r in union.collect())
    relational = stability.accuracy_and_f1(predictions["RandomForest"]).first()
    assert relational.accuracy == pytest.approx(scores["RandomForest"]["accuracy"])
    assert relational.f1 == pytest.approx(scores["RandomForest"]["f1"])


def test_fit_does_not_depend_on_storage(table, monkeypatch):
    monkeypatch.setattr(stability, "ROWS_PER_TRAINING_TASK", 70)
    vectors = stability.feature_vectors(table)
    a = stability.fit_forest(vectors.repartition(3, "edit_velocity"))
    b = stability.fit_forest(vectors.repartition(17).orderBy("reversion_rate"))
    assert list(a.featureImportances) == list(b.featureImportances)
    assert stability.in_fixed_order(vectors).rdd.getNumPartitions() == 5


def test_relational_scores_match_evaluators(scored):
    vectors = scored.withColumn("rawPrediction", array_to_vector(F.array(1 - F.col("score"), "score")))
    evaluated = stability.evaluate(vectors)
    assert stability.area_under_roc(scored).first().auc == pytest.approx(evaluated["auc"], abs=1e-12)
    both = stability.accuracy_and_f1(scored).first()
    assert (both.accuracy, both.f1) == (pytest.approx(evaluated["accuracy"]), pytest.approx(evaluated["f1"]))
    cells = stability.confusion_matrix(scored).collect()
    assert sum(r["count"] for r in cells) == 800 and len(cells) == 4


def test_roc_curve_encloses_the_area(scored):
    points = sorted((r.fpr, r.tpr) for r in charts.roc_points(scored).collect())
    points = [(0.0, 0.0), *points]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert points[-1] == (1.0, 1.0)
    assert area == pytest.approx(stability.area_under_roc(scored).first().auc)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.2, 1.0), (0.4, 1.0)], "score DOUBLE, stability_label DOUBLE")
    assert stability.area_under_roc(df).first().auc is None
    assert {r.tpr for r in charts.roc_points(df).collect()} == {1.0, 0.5}
