"""Models as tables: replayed by plain loops and in SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillwatch.operators import models, stability


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(400):
        rate = rng.random() * 0.3
        data.append((f"A{i}", rng.choice(["political", "cultural", "unknown", "scientific"]), rate, rate * 10 + rng.random(), rng.randrange(50), rng.random() - rate, 7))
    df = spark.createDataFrame(
        data, "article_title STRING, topic_category STRING, reversion_rate DOUBLE, edit_velocity DOUBLE, unique_editors BIGINT, editor_diversity DOUBLE, claims_count INT"
    )
    rest = set(stability.NUMERIC_FEATURES) - set(df.columns)
    noise = {name: F.abs(F.hash("article_title", F.lit(name)) % 97).cast("double") for name in rest}
    return stability.train_test_split(stability.feature_vectors(stability.with_label(df.withColumns(noise))).cache())


@pytest.fixture(scope="module")
def forest(rows):
    return stability.fit_forest(rows[0])


@pytest.fixture(scope="module")
def nodes(spark, forest):
    return models.forest_nodes(forest, spark).cache()


@pytest.fixture(scope="module")
def regression(rows):
    return stability.fit_regression(rows[0])


def by_article(df, *columns):
    return {r.article_title: [r[c] for c in columns] for r in df.collect()}


def test_replay_equals_the_model_on_every_row(rows, forest, nodes):
    for part in rows:
        told = by_article(stability.predictions_of(forest, part), "probability", "prediction")
        again = by_article(models.replay_forest(part, nodes, stability.FOREST["maxDepth"]), "probability", "prediction")
        assert told.keys() == again.keys() and len(told) > 50
        for title, (p, label) in told.items():
            assert np.allclose(p.toArray(), again[title][0], rtol=0, atol=1e-9)
            assert label == again[title][1] or abs(p[0] - 0.5) < 1e-9


def test_replay_in_sql_from_the_written_nodes(rows, forest, nodes, tmp_path):
    nodes.write.parquet(f"{tmp_path}/nodes")
    rows[1].select("article_title", vector_to_array("features").alias("x")).write.parquet(f"{tmp_path}/rows")
    found = duckdb.sql(f"""
        WITH RECURSIVE nodes AS (FROM '{tmp_path}/nodes/*.parquet'), rows AS (FROM '{tmp_path}/rows/*.parquet'), walk AS (
            SELECT article_title, x, tree, 0 AS node FROM rows, (SELECT DISTINCT tree FROM nodes)
            UNION ALL
            SELECT w.article_title, w.x, w.tree,
                   CASE WHEN CASE WHEN n.threshold IS NULL THEN list_contains(n.left_categories, w.x[n.feature + 1]) ELSE w.x[n.feature + 1] <= n.threshold END
                        THEN n.left_node ELSE n.right_node END
            FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.left_node IS NOT NULL)
        SELECT article_title, avg(class_counts[2] / list_sum(class_counts)) FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
        WHERE n.left_node IS NULL GROUP BY 1""").fetchall()
    told = by_article(stability.predictions_of(forest, rows[1]), "probability")
    assert len(found) == len(told)
    assert all(abs(told[title][0][1] - p) < 1e-9 for title, p in found)


def test_nodes_are_whole_trees(nodes):
    trees = {}
    for n in nodes.collect():
        trees.setdefault(n.tree, {})[n.node] = n
    assert len(trees) == stability.FOREST["numTrees"]
    kinds = set()
    for tree in trees.values():
        children = [c for n in tree.values() for c in (n.left_node, n.right_node) if c is not None]
        assert sorted(children) == sorted(set(tree) - {models.ROOT})
        for n in tree.values():
            kinds.add("leaf" if n.left_node is None else "categories" if n.threshold is None else "threshold")
            if n.left_node is not None:
                sides = zip(tree[n.left_node].class_counts, tree[n.right_node].class_counts)
                assert n.class_counts == [a + b for a, b in sides]
    assert kinds == {"leaf", "categories", "threshold"}


def test_importance_equals_the_models(forest, nodes):
    got = {r.feature: r.importance for r in models.importance_of(nodes).collect()}
    assert list(got) and set(got) == set(stability.FEATURES)
    for name, told in zip(stability.FEATURES, forest.featureImportances.toArray()):
        assert abs(got[name] - told) < 1e-9
    assert got["claims_count"] == 0.0  # constant


def test_importance_of_trees_that_do_not_split(spark, nodes):
    leaves = spark.createDataFrame([(0, 0, None, None, None, None, None, [3.0, 0.0])], nodes.schema)
    assert {r.importance for r in models.importance_of(leaves).collect()} == {0.0}


def gaps_by_hand(rows, values):
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.stability_label for r in rows])
    error = 1 / (1 + np.exp(-(x @ values[:-1] + values[-1]))) - y
    ridge = stability.REGRESSION["regParam"] * (1 - stability.REGRESSION["elasticNetParam"])
    lasso = stability.REGRESSION["regParam"] * stability.REGRESSION["elasticNetParam"]
    out = []
    for j in range(x.shape[1]):
        deviation = x[:, j].std(ddof=1) if np.ptp(x[:, j]) else 0.0
        slope = (error * x[:, j]).mean() / deviation if deviation else 0.0
        b = values[j] * deviation
        out.append(abs(values[j]) if not deviation else max(abs(slope) - lasso, 0) if not b else abs(slope + ridge * b + math.copysign(lasso, b)))
    return [*out, abs(error.mean())]


def test_fitted_coefficients_are_at_the_minimum(spark, rows, regression):
    table = models.coefficient_table(regression, spark)
    got = {r.place: r.gap for r in models.optimality(rows[0], table).collect()}
    by_hand = gaps_by_hand(rows[0].collect(), np.array([*regression.coefficients.toArray(), regression.intercept]))
    assert [got[i] for i in range(11)] == pytest.approx(by_hand, abs=1e-12)
    assert max(got.values()) < regression.getTol()
    assert any(c == 0 for c in regression.coefficients.toArray()) and any(c != 0 for c in regression.coefficients.toArray())


def test_other_coefficients_are_not(spark, rows, regression):
    for place in range(11):
        table = models.coefficient_table(regression, spark)
        moved = table.withColumn("coefficient", F.when(F.col("place") == place, F.col("coefficient") + 0.01).otherwise(F.col("coefficient")))
        got = {r.place: r.gap for r in models.optimality(rows[0], moved).collect()}
        assert got[place] > 1e-4


def test_gap_in_sql(spark, rows, regression, tmp_path):
    models.coefficient_table(regression, spark).write.parquet(f"{tmp_path}/w")
    rows[0].select("stability_label", vector_to_array("features").alias("x")).write.parquet(f"{tmp_path}/rows")
    found = duckdb.sql(f"""
        WITH w AS (FROM '{tmp_path}/w/*.parquet'),
        v AS (SELECT list(coefficient ORDER BY place) AS w FROM w),
        e AS (SELECT x, 1 / (1 + exp(-(list_dot_product(x, w[1:10]) + w[11]))) - stability_label AS e FROM '{tmp_path}/rows/*.parquet', v),
        s AS (SELECT j - 1 AS place, CASE WHEN min(x[j]) = max(x[j]) THEN 0 ELSE stddev_samp(x[j]) END AS sd, avg(e * x[j]) / nullif(sd, 0) AS slope FROM e, range(1, 11) r(j) GROUP BY j)
        SELECT place, CASE WHEN sd = 0 THEN abs(coefficient) WHEN coefficient = 0 THEN greatest(abs(slope) - 0.005, 0)
                           ELSE abs(slope + 0.005 * coefficient * sd + 0.005 * sign(coefficient)) END
        FROM s JOIN w USING (place) UNION ALL SELECT 10, abs(avg(e)) FROM e ORDER BY 1""").fetchall()
    got = {r.place: r.gap for r in models.optimality(rows[0], models.coefficient_table(regression, spark)).collect()}
    assert [g for _, g in found] == pytest.approx([got[i] for i in range(11)], abs=1e-9)
