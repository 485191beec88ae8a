"""Raw records to the clean revision, entity and pageview tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import UNKNOWN_TOPIC, event_time, revert_flag, view_date
from quillwatch.operators.sequences import first_of_each


def clean_revisions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "article_title",
        "pageid",
        "revid",
        "parentid",
        event_time("timestamp").alias("edit_timestamp"),
        "user",
        "userid",
        "comment",
        F.col("size").alias("content_length"),
        revert_flag("comment").alias("is_revert"),
    ).dropna(subset=["article_title", "revid"])


def clean_pageviews(raw: DataFrame) -> DataFrame:
    return raw.select("article_title", view_date("timestamp").alias("view_date"), "views").dropna(
        subset=["article_title", "views"]
    )


def topic_dimension(curated: DataFrame) -> DataFrame:
    """One row per title from curated lists (article_title, topic_category, list_order);
    a title on several lists takes the topic of the last one."""
    return curated.groupBy("article_title").agg(
        F.max_by("topic_category", "list_order").alias("topic_category")
    )


def assign_topic(titled: DataFrame, topics: DataFrame) -> DataFrame:
    """Left lookup of the topic. Titles are unique on the topic side, so no row multiplies;
    whether that side is broadcast is left to its measured size."""
    return titled.join(topics.select("article_title", "topic_category"), "article_title", "left").fillna(
        {"topic_category": UNKNOWN_TOPIC}
    )


def clean_entities(raw: DataFrame, topics: DataFrame) -> DataFrame:
    kept = raw.select(
        "article_title", "qid", "label", "description", "claims_count", "sitelinks_count"
    )
    return assign_topic(kept, topics)


def cap_revisions(revisions: DataFrame, per_article: int = 5000, **split) -> DataFrame:
    """The oldest ``per_article`` revisions of every article."""
    return first_of_each(revisions, per_article, **split)


def new_keys(incoming: DataFrame, stored: DataFrame, key: str = "article_title") -> DataFrame:
    """Keys that have not been ingested yet."""
    return incoming.select(key).distinct().join(stored.select(key).distinct(), key, "left_anti")
