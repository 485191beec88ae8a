"""Replies of the revision, entity and pageview web APIs, given as one JSON text per row with
the title that was asked for, flattened to the records of the raw feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch import schemas
from quillwatch.functions import linked_ids


def flatten_revisions(replies: DataFrame) -> DataFrame:
    """One row per revision. A page that does not exist is listed under id -1 and has none."""
    reply = F.from_json("reply", schemas.REVISION_REPLY)
    pages = replies.select("article_title", F.explode(reply["query"]["pages"]).alias("page_id", "page"))
    revisions = pages.filter(F.col("page_id") != "-1").select(
        "article_title",
        F.col("page_id").try_cast("bigint").alias("pageid"),
        F.explode("page.revisions").alias("r"),
    )
    return revisions.select("r.*", "article_title", "pageid")


def flatten_entities(replies: DataFrame) -> DataFrame:
    """The first entity of each reply; nothing when it is marked missing. Claims are counted
    by property. A label falls back to the title, a description to empty text."""
    reply = F.from_json("reply", schemas.ENTITY_REPLY)
    first = replies.select(
        "article_title", F.try_element_at(F.map_entries(reply["entities"]), F.lit(1)).alias("entry")
    ).select("article_title", F.col("entry.key").alias("qid"), F.col("entry.value").alias("e"))
    english = lambda texts: F.try_element_at(texts, F.lit("en"))["value"]
    size = lambda m: F.coalesce(F.size(m), F.lit(0))
    return first.filter((F.col("qid") != "-1") & F.col("e.missing").isNull()).select(
        "qid",
        "article_title",
        F.coalesce(english(F.col("e.labels")), F.col("article_title")).alias("label"),
        F.coalesce(english(F.col("e.descriptions")), F.lit("")).alias("description"),
        F.when(F.col("e.claims").isNull(), 0).otherwise(size(F.col("e.claims"))).alias("claims_count"),
        F.when(F.col("e.sitelinks").isNull(), 0).otherwise(size(F.col("e.sitelinks"))).alias("sitelinks_count"),
        linked_ids(F.col("e.claims"), "P31").alias("instance_of"),
        linked_ids(F.col("e.claims"), "P361").alias("part_of"),
    )


def flatten_pageviews(replies: DataFrame) -> DataFrame:
    reply = F.from_json("reply", schemas.PAGEVIEW_REPLY)
    return replies.select("article_title", F.explode(reply["items"]).alias("i")).select(
        "i.*", "article_title"
    )
