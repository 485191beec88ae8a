"""Tables behind the charts of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import TOPICS, display_title, topic_label
from quillwatch.operators.graph import editor_degree, symmetric_adjacency
from quillwatch.operators.sequences import running_totals
from quillwatch.operators.topics import averages_by_topic, known_topics

# The averages that are drawn.
CHARTED = ("avg_reversion_rate", "avg_edit_velocity", "avg_unique_editors")
TOP_EDGES = 200
LABELLED = 10


def topic_chart_stats(features: DataFrame) -> DataFrame:
    """Three averages per topic in display order; a topic without articles has nulls."""
    stats = averages_by_topic(features, CHARTED).drop("article_count")
    ordered = features.sparkSession.createDataFrame(
        list(enumerate(TOPICS)), "display_order INT, topic_category STRING"
    )
    return ordered.join(stats, "topic_category", "left").orderBy("display_order")


def stability_score(features: DataFrame) -> DataFrame:
    return known_topics(features).select(
        "article_title",
        "topic_category",
        "editor_diversity",
        (1.0 - F.col("reversion_rate")).alias("stability_score"),
    )


def titles_for_display(features: DataFrame) -> DataFrame:
    return features.select(
        "article_title",
        display_title("article_title").alias("display_title"),
        topic_label("topic_category").alias("topic_label"),
    )


def top_edges(edges: DataFrame, n: int = TOP_EDGES) -> DataFrame:
    return edges.orderBy(F.desc("co_edit_count"), F.asc("editor_a"), F.asc("editor_b")).limit(n)


def graph_summary(edges: DataFrame) -> DataFrame:
    """Nodes, edges and heaviest edge, in one row."""
    nodes = symmetric_adjacency(edges).agg(F.countDistinct("editor")).scalar()
    return edges.agg(
        F.count(F.lit(1)).alias("edges"), F.max("co_edit_count").alias("max_weight")
    ).select(nodes.alias("nodes"), "edges", "max_weight")


def top_degree_labels(edges: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """Nodes whose degree reaches the ``labelled``-th largest, ties included; all nodes when
    there are no more than that. The cut-off comes from a top-k, not from ranking all nodes."""
    degree = editor_degree(symmetric_adjacency(edges)).select("editor", "degree")
    leading = degree.orderBy(F.desc("degree")).limit(labelled + 1)
    enough = leading.agg(F.count(F.lit(1))).scalar() > labelled
    cutoff = degree.orderBy(F.desc("degree")).limit(labelled).agg(F.min("degree")).scalar()
    return degree.filter(F.col("degree") >= F.when(enough, cutoff).otherwise(0))


def score_counts(scored: DataFrame, score: str = "score", label: str = "stability_label") -> DataFrame:
    """Positives and negatives per distinct score; rows without a score take no part."""
    return scored.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1.0).alias("pos"), F.count_if(F.col(label) != 1.0).alias("neg")
    )


def roc_points(scored: DataFrame, score: str = "score", label: str = "stability_label") -> DataFrame:
    """One point per distinct score, taken as threshold: the share of negatives and of
    positives that score at least that much."""
    below = running_totals(score_counts(scored, score, label), "score", ["pos", "neg"])
    share = lambda c: (F.col(f"all_{c}") - F.col(f"below_{c}")) / F.greatest(f"all_{c}", F.lit(1))
    return below.select(F.col("score").alias("threshold"), share("neg").alias("fpr"), share("pos").alias("tpr"))
