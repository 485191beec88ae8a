"""Fitted models as tables: what they predict and why can be recomputed with joins and sums.

A forest is a table of nodes, at most trees times 2^(depth + 1) rows, which is the bound of its broadcasts. Rows go down
all trees level by level, by a join on (tree, node). A regression is a table of coefficients, which are proved by the
conditions that hold at the minimum of its loss.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwatch.operators.stability import FEATURES, REGRESSION
from quillwatch.session import fresh_path

ROOT = 0
INTERCEPT = "intercept"


def forest_nodes(forest, spark) -> DataFrame:
    """One row per node, as the model itself writes them: tree, node, left_node and right_node (null for a leaf), feature (place in
    the vector), threshold or left_categories, and class_counts."""
    path = fresh_path(spark, "forest")
    forest.save(path)
    stored = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner, numeric = F.col("leftChild") >= 0, F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    return stored.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left_node"),
        F.when(inner, F.col("rightChild")).alias("right_node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & numeric, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~numeric, values).alias("left_categories"),
        F.col("impurityStats").alias("class_counts"),
    )


def importance_of(nodes: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """(feature, importance): what splits by each feature take off the Gini impurity of the rows they split, as shares of
    the tree, averaged over trees that split at all. Features that no tree uses have 0."""
    size = F.aggregate("class_counts", F.lit(0.0), lambda n, c: n + c)
    # Rows of a node that a draw by its class shares would mislabel.
    mislabelled = size - F.try_divide(F.aggregate("class_counts", F.lit(0.0), lambda n, c: n + c * c), size)
    weights = nodes.select("tree", "node", F.coalesce(mislabelled, F.lit(0.0)).alias("mislabelled"))
    child = lambda side: weights.select("tree", F.col("node").alias(f"{side}_node"), F.col("mislabelled").alias(side))
    inner = nodes.where("left_node IS NOT NULL").join(weights, ["tree", "node"])
    split = inner.join(child("left"), ["tree", "left_node"]).join(child("right"), ["tree", "right_node"])
    gains = split.groupBy("tree", "feature").agg(F.sum(F.col("mislabelled") - F.col("left") - F.col("right")).alias("gain"))
    per_tree = gains.groupBy("tree").agg(F.sum("gain").alias("all"))
    shares = gains.join(per_tree, "tree").where("all <> 0").groupBy("feature").agg(F.sum(F.col("gain") / F.col("all")).alias("share"))
    total = shares.agg(F.sum("share")).scalar()
    named = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature INT, name STRING")
    return named.join(shares, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce(F.try_divide("share", total), F.lit(0.0)).alias("importance")
    )


def replay_forest(rows: DataFrame, nodes: DataFrame, depth: int, key: str = "article_title", features: str = "features") -> DataFrame:
    """(key, probability, prediction) of each row, by walking down every tree. ``key`` is unique."""
    splits = F.broadcast(nodes.where("left_node IS NOT NULL").select("tree", "node", "left_node", "right_node", "feature", "threshold", "left_categories"))
    trees = nodes.where(F.col("node") == ROOT).select("tree")
    all_trees = trees.agg(F.sort_array(F.collect_list("tree"))).scalar()
    at = rows.select(F.col(key), vector_to_array(features).alias("x"), F.explode(all_trees).alias("tree")).withColumn("node", F.lit(ROOT))
    value = F.get("x", F.col("feature"))
    goes_left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("left_categories", value))
    for _ in range(depth):
        step = F.when(F.col("left_node").isNull(), F.col("node")).when(goes_left, F.col("left_node")).otherwise(F.col("right_node"))
        at = at.join(splits, ["tree", "node"], "left").select(key, "x", "tree", step.alias("node"))
    counts = nodes.select("tree", "node", "class_counts")
    size = F.aggregate("class_counts", F.lit(0.0), lambda n, c: n + c)
    votes = at.join(F.broadcast(counts), ["tree", "node"]).select(key, F.get("class_counts", F.lit(0)).alias("a"), F.get("class_counts", F.lit(1)).alias("b"), size.alias("n"))
    share = lambda c: F.sum(F.try_divide(c, F.col("n"))) / F.count(F.lit(1))
    found = votes.groupBy(key).agg(share(F.col("a")).alias("p0"), share(F.col("b")).alias("p1"))
    return found.select(key, F.array("p0", "p1").alias("probability"), F.when(F.col("p1") > F.col("p0"), 1.0).otherwise(0.0).alias("prediction"))


def coefficient_table(regression, spark, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """(place, feature, coefficient), the intercept last."""
    values = [*map(float, regression.coefficients.toArray()), float(regression.intercept)]
    rows = [(i, name, value) for i, (name, value) in enumerate(zip([*names, INTERCEPT], values))]
    return spark.createDataFrame(rows, "place INT, feature STRING, coefficient DOUBLE")


def _column_sums(rows: DataFrame, x: Column, error: Column, n_features: int) -> DataFrame:
    """One pass: rows, sum of errors, and per feature the sum of error times value and the sample deviation."""
    at = lambda j: F.get(x, F.lit(j))
    # The deviation of a constant is 0, whatever the last digit of its computation.
    deviation = lambda v: F.when(F.min(v) == F.max(v), 0.0).otherwise(F.stddev_samp(v))
    per_feature = [F.struct(F.sum(error * at(j)).alias("slope"), deviation(at(j)).alias("deviation")) for j in range(n_features)]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(error).alias("error"), F.array(*per_feature).alias("f"))
    return sums.select("n", "error", F.posexplode("f").alias("place", "f")).select("n", "error", "place", "f.*")


def optimality(rows: DataFrame, coefficients: DataFrame, penalty: dict = REGRESSION, label: str = "stability_label", features: str = "features") -> DataFrame:
    """(feature, coefficient, gap): by how much each coefficient misses the condition of the minimum.

    The loss is the mean log loss plus the elastic net on coefficients of standardised features. At its minimum the slope
    of the log loss is opposite to the slope of the penalty; where a coefficient is 0, it may be anything up to the
    penalty's jump there. The intercept has no penalty; the coefficient of a constant feature has to be 0. One aggregate over the rows."""
    n_features = coefficients.where(F.col("feature") != INTERCEPT).count()
    weights = coefficients.agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "coefficient"))), lambda c: c["coefficient"])).scalar()
    x = vector_to_array(features)
    placed = rows.select(x.alias("x"), F.col(label).alias("y"), weights.alias("w"))
    products = F.zip_with("x", F.slice("w", 1, n_features), lambda a, b: a * b)
    score = F.aggregate(products, F.get("w", F.lit(n_features)), lambda s, p: s + p)
    error = 1 / (1 + F.exp(-score)) - F.col("y")
    sums = _column_sums(placed.withColumn("e", error), F.col("x"), F.col("e"), n_features)
    ridge = penalty["regParam"] * (1 - penalty["elasticNetParam"])
    lasso = penalty["regParam"] * penalty["elasticNetParam"]
    scaled = F.col("coefficient") * F.col("deviation")
    slope = F.try_divide("slope", "deviation") / F.col("n")
    gap = (
        F.when(F.col("deviation") == 0, F.abs("coefficient"))
        .when(F.col("coefficient") == 0, F.greatest(F.abs(slope) - lasso, F.lit(0.0)))
        .otherwise(F.abs(slope + ridge * scaled + lasso * F.signum(scaled)))
    )
    per_feature = sums.join(coefficients, "place").select("place", "feature", "coefficient", gap.alias("gap"))
    first = sums.where("place = 0").select(F.lit(n_features).alias("place"), F.abs(F.col("error") / F.col("n")).alias("gap"))
    return per_feature.unionByName(coefficients.join(first, "place").select("place", "feature", "coefficient", "gap"))
