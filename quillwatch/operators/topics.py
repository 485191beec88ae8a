"""Comparison of topics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import TOPICS

# The columns of the comparison, and the feature each of them averages.
AVERAGES = {
    "avg_reversion_rate": "reversion_rate",
    "avg_edit_velocity": "edit_velocity",
    "avg_unique_editors": "unique_editors",
    "avg_editor_diversity": "editor_diversity",
    "avg_total_edits": "total_edits",
    "avg_daily_views": "avg_daily_views",
    "avg_spike_ratio": "pageview_spike_ratio",
}


def known_topics(features: DataFrame) -> DataFrame:
    return features.filter(F.col("topic_category").isin(*TOPICS))


def averages_by_topic(features: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named averages and the number of articles of every topic."""
    averages = [F.avg(AVERAGES[c]).alias(c) for c in columns]
    by_topic = known_topics(features).groupBy("topic_category")
    return by_topic.agg(*averages, F.count(F.lit(1)).alias("article_count"))


def topic_comparison(features: DataFrame) -> DataFrame:
    return averages_by_topic(features, AVERAGES).orderBy("topic_category")
