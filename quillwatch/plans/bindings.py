"""The domain tables, derived from the general-purpose test tables.

An event is an edit: its ``k`` names the article, its user the editor, an ``error`` is a
revert. A ``view`` event also counts as one page view. Parts describe entities.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillwatch.operators import cleaning, coediting, episodes, features, stability
from quillwatch.session import fresh_path

# An API reply, and an array line of the raw feed, carries one run of this many ids.
BATCH = 50


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _article() -> Column:
    return F.concat(F.lit("A"), F.get_json_object("props", "$.k"))


def revisions(spark: SparkSession, folder: str) -> DataFrame:
    return as_revisions(table(spark, folder, "events"))


def as_revisions(events: DataFrame) -> DataFrame:
    return events.select(
        _article().alias("article_title"),
        F.col("event_id").alias("revid"),
        F.concat(F.lit("U"), F.col("user_id")).alias("user"),
        F.col("user_id").alias("userid"),
        F.col("ts").cast("timestamp").alias("edit_timestamp"),
        F.round(F.col("value") * 100).cast("bigint").alias("content_length"),
        (F.col("event_type") == "error").alias("is_revert"),
    )


def pageviews(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "view")
        .groupBy(_article().alias("article_title"), F.col("ts").cast("date").alias("view_date"))
        .agg(F.count(F.lit(1)).alias("views"))
    )


def curated_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Topic lists in the shape a user supplies them."""
    kind = F.col("p_type")
    topic = (
        F.when(kind.isin("ECONOMY", "LARGE"), "political")
        .when(kind.isin("MEDIUM", "PROMO"), "scientific")
        .when(kind == "SMALL", "cultural")
    )
    order = F.when(topic == "political", 1).when(topic == "scientific", 2).otherwise(3)
    return (
        table(spark, folder, "part")
        .select(
            F.concat(F.lit("A"), F.col("p_partkey")).alias("article_title"),
            topic.alias("topic_category"),
            order.alias("list_order"),
        )
        .filter(F.col("topic_category").isNotNull())
    )


def raw_entities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.concat(F.lit("Q"), F.col("p_partkey")).alias("qid"),
        F.concat(F.lit("A"), F.col("p_partkey")).alias("article_title"),
        F.col("p_name").alias("label"),
        F.col("p_brand").alias("description"),
        F.col("p_size").cast("int").alias("claims_count"),
        F.length("p_name").alias("sitelinks_count"),
        F.array(F.concat(F.lit("Q"), F.col("p_size"))).alias("instance_of"),
        F.array(F.col("p_type")).alias("part_of"),
    )


def entities(spark: SparkSession, folder: str) -> DataFrame:
    topics = cleaning.topic_dimension(curated_topics(spark, folder))
    return cleaning.clean_entities(raw_entities(spark, folder), topics)


def raw_revisions(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    comment = (
        F.when(kind == "error", F.concat(F.lit("Undid revision "), F.col("event_id")))
        .when(kind == "view", F.lit("conserv fix"))
        .when(kind == "click", F.lit(""))
        .when(kind == "purchase", F.lit("copy edit"))
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("revid"),
        (F.col("event_id") - 1).alias("parentid"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.concat(F.lit("U"), F.col("user_id")).alias("user"),
        F.col("user_id").alias("userid"),
        comment.alias("comment"),
        F.round(F.col("value") * 100).cast("bigint").alias("size"),
        _article().alias("article_title"),
        F.get_json_object("props", "$.k").cast("bigint").alias("pageid"),
    )


def raw_pageviews(spark: SparkSession, folder: str) -> DataFrame:
    return pageviews(spark, folder).select(
        F.lit("en.project").alias("project"),
        F.col("article_title").alias("article"),
        F.lit("daily").alias("granularity"),
        F.date_format("view_date", "yyyyMMdd'00'").alias("timestamp"),
        F.lit("all-access").alias("access"),
        F.lit("all-agents").alias("agent"),
        "views",
        "article_title",
    )


def write_array_lines(records: DataFrame, batch: Column, name: str) -> str:
    """Records as text lines that each hold a JSON array of one batch; returns the folder."""
    path = fresh_path(records.sparkSession, name)
    (
        records.groupBy(batch.alias("_batch"))
        .agg(F.to_json(F.collect_list(F.struct(*records.columns))).alias("value"))
        .select("value")
        .write.text(path)
    )
    return path


def revision_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies with at most ``BATCH`` revisions each, and one for a page that does not exist
    per entity without edits."""
    raw = raw_revisions(spark, folder)
    record = F.struct("revid", "parentid", "timestamp", "user", "userid", "comment", "size")
    found = (
        raw.groupBy("article_title", "pageid", F.floor(F.col("revid") / BATCH).alias("_batch"))
        .agg(F.collect_list(record).alias("revisions"))
        .select(
            "article_title",
            F.to_json(
                F.struct(
                    F.struct(
                        F.create_map(F.col("pageid").cast("string"), F.struct("revisions")).alias("pages")
                    ).alias("query")
                )
            ).alias("reply"),
        )
    )
    absent = cleaning.new_keys(raw_entities(spark, folder), raw).select(
        "article_title", F.lit('{"query":{"pages":{"-1":{"missing":""}}}}').alias("reply")
    )
    return found.unionByName(absent)


def paged_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Histories in pages of one to seven revisions, by article. Some pages are missing, some come twice, and some
    articles have two more pages that lead to each other."""
    raw = raw_revisions(spark, folder)
    order = Window.partitionBy("article_title").orderBy("revid")
    number = F.floor((F.row_number().over(order) - 1) / (1 + F.col("pageid") % 7))
    record = F.struct("revid", "parentid", "timestamp", "user", "userid", "comment", "size")
    pages = raw.withColumn("_page", number).groupBy("article_title", "pageid", "_page").agg(
        F.sort_array(F.collect_list(record)).alias("revisions"), F.min("revid").alias("first")
    )
    pages = pages.withColumn("next", F.lead("first").over(Window.partitionBy("article_title").orderBy("_page")))
    found = pages.filter(F.col("first") % 13 != 4)
    again = found.filter(F.col("first") % 5 == 1)
    circle = raw.filter(F.col("pageid") % 10 == 3).select("article_title", "pageid").distinct()
    here, there = 10**12 + 2 * F.col("pageid"), 10**12 + 2 * F.col("pageid") + 1
    round_ = [
        circle.select("article_title", "pageid", F.array(F.struct(first.alias("revid"))).alias("revisions"), following.alias("next"))
        for first, following in ((here, there), (there, here))
    ]
    told = found.unionByName(again).select("article_title", "pageid", "revisions", "next")
    for pages in round_:
        told = told.unionByName(pages.withColumn("revisions", F.from_json(F.to_json("revisions"), found.schema["revisions"].dataType)))
    token = F.struct(F.when(F.col("next").isNotNull(), F.concat(F.lit("20240101000000|"), F.col("next"))).alias("rvcontinue"))
    body = F.struct(F.create_map(F.col("pageid").cast("string"), F.struct("revisions")).alias("pages"))
    return told.select("article_title", F.to_json(F.struct(token.alias("continue"), body.alias("query"))).alias("reply"))


def entity_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Entity replies of varied shape: a missing entity, absent labels, claims that point to
    an entity and claims that hold text."""
    claim = (
        '{{"mainsnak":{{"datavalue":{{"type":"{kind}","value":{value}}}}}}}'.format
    )
    to_entity = claim(kind="wikibase-entityid", value='{"id":"Q%1$d"}')
    to_text = claim(kind="string", value='"note"')
    p31 = f'"P31":[{to_entity},{to_text}]'
    p361 = f'"P361":[{to_entity}]'
    odd = F.col("p_size") % 2 == 1
    claims = F.when(odd, F.format_string(p31 + "," + p361, "p_size")).otherwise(F.format_string(p31, "p_size"))
    texts = F.when(F.col("p_type") == "SMALL", F.lit('"labels":{},"descriptions":{}')).otherwise(
        F.format_string(
            '"labels":{"en":{"value":"%s"}},"descriptions":{"en":{"value":"%s"}}', "p_name", "p_brand"
        )
    )
    links = F.array_join(
        F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: F.format_string('"s%d":{"title":"t"}', i)), ","
    )
    body = F.when(
        F.col("p_type") == "STANDARD", F.lit('{"entities":{"-1":{"missing":""}}}')
    ).otherwise(
        F.concat(
            F.format_string('{"entities":{"Q%d":{"claims":{', "p_partkey"),
            claims,
            F.lit("},"),
            texts,
            F.lit(',"sitelinks":{'),
            links,
            F.lit("}}}}"),
        )
    )
    return table(spark, folder, "part").select(
        F.concat(F.lit("A"), F.col("p_partkey")).alias("article_title"), body.alias("reply")
    )


def pageview_replies(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_pageviews(spark, folder)
    month = F.substring("timestamp", 1, 6)
    item = F.struct("project", "article", "granularity", "timestamp", "access", "agent", "views")
    return raw.groupBy("article_title", month.alias("_month")).agg(
        F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("reply")
    ).drop("_month")


def article_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return features.article_metrics(revisions(spark, folder))


def joined_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.join_features(
        article_metrics(spark, folder),
        entities(spark, folder),
        features.pageview_features(pageviews(spark, folder)),
    )


def article_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.fill_defaults(joined_features(spark, folder))


def weekly(spark: SparkSession, folder: str) -> DataFrame:
    return episodes.weekly_edit_stats(revisions(spark, folder))


def edges(spark: SparkSession, folder: str) -> DataFrame:
    return coediting.coedit_graph(revisions(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed score against the revert flag, for the evaluation operators."""
    score = (F.col("event_id") * 7919) % 1000 / 1000.0
    return table(spark, folder, "events").select(
        "event_id",
        score.alias("score"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("stability_label"),
        F.when(score >= 0.5, 1.0).otherwise(0.0).alias("prediction"),
    )


def fixed_predictions(spark: SparkSession, folder: str, salt: str) -> DataFrame:
    """Predictions of a stand-in model on the held-out articles: a hash of the title."""
    _, test = stability.train_test_split(stability.with_label(article_features(spark, folder)))
    percent = F.conv(F.substring(F.md5(F.concat("article_title", F.lit(salt))), 1, 8), 16, 10).cast("bigint") % 100
    p = percent / 100.0
    return test.select(
        "article_title",
        "stability_label",
        F.when(p >= 0.5, 1.0).otherwise(0.0).alias("prediction"),
        array_to_vector(F.array(1 - p, p)).alias("probability"),
    )
