"""Weekly edit statistics and the weeks that qualify as edit wars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import per, week_start

# A week is an edit war above this reversion rate, from this many edits on.
WAR_RATE = 0.3
WAR_EDITS = 10


def weekly_edit_stats(revisions: DataFrame) -> DataFrame:
    return (
        revisions.groupBy("article_title", week_start("edit_timestamp").alias("week_start"))
        .agg(
            F.count("revid").alias("weekly_edits"),
            F.count_if("is_revert").alias("weekly_reverts"),
            F.countDistinct("user").alias("weekly_editors"),
        )
        .withColumn("weekly_reversion_rate", per("weekly_reverts", "weekly_edits"))
    )


def edit_wars(weekly: DataFrame) -> DataFrame:
    return weekly.filter(
        (F.col("weekly_reversion_rate") > WAR_RATE) & (F.col("weekly_edits") >= WAR_EDITS)
    )


def topic_lookup(features: DataFrame) -> DataFrame:
    return features.select("article_title", "topic_category").distinct()


def edit_wars_by_topic(wars: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Edit wars in article and week order, with topics when features are at hand."""
    if features is not None:
        wars = wars.join(topic_lookup(features), "article_title", "left")
    return wars.orderBy("article_title", "week_start")


def weeks_per_article(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("article_title").agg(F.count(F.lit(1)).alias("weeks"))


def article_timeline(weekly: DataFrame, target: str | None = None) -> DataFrame:
    """Weeks of ``target``, or of the article with most weeks when there is no target or it has
    no weeks."""
    chosen = (
        weeks_per_article(weekly)
        .orderBy(F.desc(F.col("article_title").eqNullSafe(F.lit(target))), F.desc("weeks"), F.asc("article_title"))
        .limit(1)
        .select("article_title")
    )
    return (
        weekly.join(F.broadcast(chosen), "article_title", "left_semi")
        .withColumn("war_threshold", F.lit(WAR_RATE))
        .orderBy("week_start")
    )
