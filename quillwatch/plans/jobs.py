"""The whole analysis, from raw feeds to published documents and checks.

Every table is written once and later steps read the written table, so nothing is computed
twice and a lost executor never reaches further back than the step at hand.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwatch.operators import (
    charts, cleaning, coediting, episodes, features, graph, models, quality, stability, topics,
)
from quillwatch.session import exists, materialize, scratch
from quillwatch.sources import manifest, paging, raw, replies, sinks
from quillwatch.streaming import current
from quillwatch.streaming import weekly as stream


@dataclass
class Feeds:
    """Paths of the raw inputs: three JSON feeds, and ``topics``, a Parquet table
    (article_title, topic_category, list_order) of curated titles. ``pretty`` is for JSON
    documents spread over lines; with ``xml`` the revisions are XML dumps."""

    revisions: str
    entities: str
    pageviews: str
    topics: str
    pretty: bool = False
    xml: bool = False

    def counted(self) -> dict[str, tuple[str, str]]:
        """Path and key field of the JSON feeds."""
        json = {"revisions": (self.revisions, "revid"), "entities": (self.entities, "qid"), "pageviews": (self.pageviews, "views")}
        return {n: f for n, f in json.items() if not (self.xml and n == "revisions")}


KINDS = ("revisions", "entities", "pageviews")
FLATTEN = {
    "entities": (replies.flatten_entities, raw.scan_entities),
    "pageviews": (replies.flatten_pageviews, raw.scan_pageviews),
}


def add_replies(spark: SparkSession, feeds: Feeds, kind: str, found: DataFrame) -> None:
    """Flatten API replies (article_title, reply) and append the titles that the feed of this
    kind does not hold yet. Revisions come in pages, and later pages may come in later calls."""
    if kind == "revisions":
        return add_revision_pages(spark, feeds, found)
    flatten, scan = FLATTEN[kind]
    path = getattr(feeds, kind)
    records = flatten(found)
    if exists(spark, path):
        wanted = materialize(cleaning.new_keys(records, scan(spark, path, feeds.pretty)), "new-titles")
        records = records.join(wanted, "article_title", "left_semi")
    sinks.write_raw_by_title(records, path, mode="append")


def add_revision_pages(spark: SparkSession, feeds: Feeds, found: DataFrame) -> None:
    """Append what the replies add to the histories in the feed. All replies are kept beside the feed, so that a page
    that was missing in one call joins those before and behind it when it comes in another. A title that
    the feed holds from elsewhere is left alone. A call that failed half way is made good by the next for its titles."""
    path = feeds.revisions.rstrip("/")
    archive, fed = f"{path}-replies", exists(spark, path)
    kept = spark.read.parquet(archive) if exists(spark, archive) else None
    call = 1 + (kept.agg(F.coalesce(F.max("fetched"), F.lit(0))).first()[0] if kept is not None else 0)
    titles = found.select("article_title").distinct()
    if fed:
        held = raw.scan_revisions(spark, path, feeds.pretty).select("article_title").distinct()
        elsewhere = held.join(kept.select("article_title").distinct(), "article_title", "left_anti") if kept is not None else held
        titles = titles.join(elsewhere, "article_title", "left_anti")
    titles = materialize(titles, "asked-titles")
    asked = found.select("article_title", "reply").join(titles, "article_title", "left_semi")
    asked.withColumn("fetched", F.lit(call).cast("long")).write.mode("append").parquet(archive)
    pages = spark.read.parquet(archive).join(titles, "article_title", "left_semi")
    records = paging.flatten_paged_revisions(pages).drop("page_no")
    if fed:
        old = raw.scan_revisions(spark, path, feeds.pretty).select("article_title", "revid")
        records = records.join(old, ["article_title", "revid"], "left_anti")
    sinks.write_raw_by_title(materialize(records, "new-revisions"), path, mode="append")


def build_features(
    spark: SparkSession, feeds: Feeds, out: str, max_revisions: int | None = None
) -> dict[str, DataFrame]:
    """Clean tables and per-article features. ``max_revisions`` keeps only that many of the
    oldest revisions per article, as a feed that is fetched with such a cap would."""
    topic_of = cleaning.topic_dimension(spark.read.parquet(feeds.topics))
    read = raw.scan_xml_dump(spark, feeds.revisions) if feeds.xml else raw.scan_revisions(spark, feeds.revisions, feeds.pretty)
    revisions = cleaning.clean_revisions(read)
    written = {}
    if max_revisions is not None:
        written["revisions_uncapped"] = sinks.write_parquet(revisions, f"{out}/revisions_uncapped")
        revisions = cleaning.cap_revisions(written["revisions_uncapped"], max_revisions)
    tables = {
        "revisions_clean": revisions,
        "entities_clean": cleaning.clean_entities(raw.scan_entities(spark, feeds.entities, feeds.pretty), topic_of),
        "pageviews_clean": cleaning.clean_pageviews(raw.scan_pageviews(spark, feeds.pageviews, feeds.pretty)),
    }
    written |= {name: sinks.write_parquet(t, f"{out}/{name}") for name, t in tables.items()}
    joined = features.join_features(
        features.article_metrics(written["revisions_clean"]),
        written["entities_clean"],
        features.pageview_features(written["pageviews_clean"]),
    )
    written["article_features"] = sinks.write_parquet(
        features.fill_defaults(joined), f"{out}/article_features"
    )
    return written


def ingest(spark: SparkSession, feeds: Feeds, out: str) -> DataFrame:
    """Per file of each raw feed: records, records with a key, unreadable records. The totals
    are written beside them. Called again with the same ``out``, it reads only files that are new or changed."""
    found = manifest.feed_counts(spark, feeds.counted(), f"{out}/ingest_state", feeds.pretty)
    counts = sinks.write_parquet(found, f"{out}/ingest_counts")
    sinks.write_parquet(raw.totals_of(counts), f"{out}/ingest_totals")
    return counts


def analyse(
    revisions: DataFrame, article_features: DataFrame, out: str, top_editors: int | None = coediting.TOP_EDITORS
) -> dict[str, DataFrame]:
    """Co-editing network of the most active editors (None: of all), edit wars and topic
    comparison."""
    written: dict[str, DataFrame] = {}

    def keep(name: str, table: DataFrame) -> DataFrame:
        written[name] = sinks.write_parquet(table, f"{out}/{name}")
        return written[name]

    edges = keep("coediting_edges", coediting.coedit_graph(revisions, top_editors))
    keep("network_metrics", graph.network_metrics(edges))
    weekly = keep("weekly_edit_stats", episodes.weekly_edit_stats(revisions))
    keep("edit_wars", episodes.edit_wars_by_topic(episodes.edit_wars(weekly), article_features))
    keep("topic_comparison", topics.topic_comparison(article_features))
    return written


def classify(article_features: DataFrame, out: str) -> dict[str, DataFrame]:
    """Label distribution, both classifiers, the forest's nodes, the coefficients and how far they are from the
    minimum of the loss, predictions on the held-out articles, confusion matrices and metrics."""
    spark = article_features.sparkSession
    labelled = stability.with_label(article_features)
    written = {"label_distribution": sinks.write_parquet(stability.label_distribution(labelled), f"{out}/label_distribution")}
    vectors = sinks.write_parquet(stability.feature_vectors(labelled), f"{out}/feature_vectors")
    train, test = stability.train_test_split(vectors)
    fitted = {
        "random_forest": stability.fit_forest(train),
        "logistic_regression": stability.fit_regression(train),
    }
    forest, regression = fitted.values()
    written["forest_nodes"] = sinks.write_parquet(models.forest_nodes(forest, spark), f"{out}/forest_nodes")
    gaps = models.optimality(train, models.coefficient_table(regression, spark))
    written["regression_coefficients"] = sinks.write_parquet(gaps, f"{out}/regression_coefficients")
    scores = {}
    for name, model in fitted.items():
        table = f"{name}_predictions"
        written[table] = sinks.write_parquet(stability.predictions_of(model, test), f"{out}/{table}")
        scores[name] = stability.evaluate(written[table])
        written[f"{name}_confusion"] = sinks.write_parquet(
            stability.confusion_matrix(written[table]), f"{out}/{name}_confusion"
        )
    importance = stability.feature_importance(forest, spark)
    written["model_metrics"] = sinks.write_metrics(
        stability.model_metrics(scores, importance), f"{out}/model_metrics"
    )
    return written


def chart_tables(tables: dict[str, DataFrame], out: str, timeline_target: str | None = None) -> dict[str, DataFrame]:
    """What the charts of a report are drawn from."""
    top = charts.top_edges(tables["coediting_edges"])
    drawn = {
        "chart_topics": charts.topic_chart_stats(tables["article_features"]),
        "chart_stability": charts.stability_score(tables["article_features"]),
        "chart_timeline": episodes.article_timeline(tables["weekly_edit_stats"], timeline_target),
        "chart_edges": top,
        "chart_labels": charts.top_degree_labels(top),
        "chart_graph": charts.graph_summary(top),
    }
    for name in ("random_forest", "logistic_regression"):
        p = tables[f"{name}_predictions"]
        scored = p.select("stability_label", vector_to_array("probability")[1].alias("score"))
        drawn[f"chart_roc_{name}"] = charts.roc_points(scored)
    return {name: sinks.write_parquet(t, f"{out}/{name}") for name, t in drawn.items()}


def publish(tables: dict[str, DataFrame], out: str, **connector) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    predictions = {
        name: tables[f"{name}_predictions"]
        for name in ("random_forest", "logistic_regression")
        if f"{name}_predictions" in tables
    }
    collections = {
        "article_edit_metrics": tables.get("article_features"),
        "editor_network_metrics": tables.get("network_metrics"),
        "stability_predictions": stability.predictions_union(predictions) if predictions else None,
        "topic_comparison": tables.get("topic_comparison"),
    }
    return sinks.publish_documents(spark, collections, f"{out}/documents", **connector)


def verify(
    counts: DataFrame, tables: dict[str, DataFrame], published: DataFrame | None = None, minimum: int = quality.MIN_FILES
) -> DataFrame:
    """Checks over the counts of the raw files, the outputs and what was published. The feeds
    are not read again. A failed check is reported as failed."""
    totals = materialize(raw.totals_of(counts), "ingest-totals")
    files = totals.select(F.col("dataset").alias("name"), F.col("files").alias("rows"))
    clean = {
        "revisions": tables.get("revisions_uncapped", tables["revisions_clean"]),
        "entities": tables["entities_clean"],
        "pageviews": tables["pageviews_clean"],
    }
    checks = [
        quality.at_least(files, "min_files", minimum),
        quality.keyed(totals),
        quality.readable(totals),
        quality.not_silent(totals),
        quality.complete(totals, quality.table_counts(clean)),
        quality.unique_key(tables["entities_clean"], "article_title", "entities"),
        quality.unique_key(clean["revisions"], "revid", "revisions"),
        quality.outputs_present(tables, may_be_empty=("edit_wars",)),
    ]
    if "model_metrics" in tables:
        checks.append(quality.models_measured(tables["model_metrics"], len(stability.FEATURES)))
    if published is not None:
        stored = published.select(F.col("collection").alias("name"), F.col("documents").alias("rows"))
        checks.append(quality.at_least(stored, "collection", 1))
    return quality.summary(reduce(DataFrame.unionByName, checks))


def run(
    spark: SparkSession,
    feeds: Feeds,
    out: str,
    timeline_target: str | None = None,
    max_revisions: int | None = None,
    top_editors: int | None = coediting.TOP_EDITORS,
) -> DataFrame:
    """All steps; returns the outcome of the checks. Intermediate tables are deleted."""
    with scratch(spark):
        counts = ingest(spark, feeds, out)
        tables = build_features(spark, feeds, out, max_revisions)
        tables |= analyse(tables["revisions_clean"], tables["article_features"], out, top_editors)
        tables |= classify(tables["article_features"], out)
        tables |= chart_tables(tables, out, timeline_target)
        published = sinks.write_parquet(publish(tables, out), f"{out}/published")
        return sinks.write_parquet(verify(counts, tables, published), f"{out}/checks")


def follow(spark: SparkSession, feeds: Feeds, out: str) -> DataFrame:
    """Weekly statistics of the revisions that have come in since the last call, added to
    those found before; returns all finished weeks."""
    revisions = cleaning.clean_revisions(raw.stream_revisions(spark, feeds.revisions))
    return stream.run_available(stream.weekly_edit_stream(revisions), f"{out}/weekly_stream")


def follow_current(spark: SparkSession, feeds: Feeds, out: str) -> DataFrame:
    """All weeks so far, those that are still running included, after adding what has come in since the last call."""
    revisions = cleaning.clean_revisions(raw.stream_revisions(spark, feeds.revisions))
    return current.weeks(spark, current.follow(revisions, f"{out}/current_weeks"))


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    for name in ("revisions", "entities", "pageviews", "topics", "out"):
        p.add_argument(f"--{name}", required=True, help=f"path of the {name} folder")
    p.add_argument("--timeline", help="article of the timeline chart; else the one with most weeks")
    p.add_argument("--max-revisions", type=int, help="oldest revisions to keep per article")
    p.add_argument("--top-editors", type=int, default=coediting.TOP_EDITORS, help="editors in the network, 0 for all")
    p.add_argument("--pretty", action="store_true", help="JSON documents are spread over lines")
    p.add_argument("--xml", action="store_true", help="revisions are XML dumps")
    p.add_argument("--follow", action="store_true", help="only bring the weekly statistics up to date")
    p.add_argument("--current", action="store_true", help="the same with the weeks that are still running")
    for kind in KINDS:
        p.add_argument(f"--{kind}-replies", help=f"Parquet table (article_title, reply) to add to the {kind} first")
    a = p.parse_args()
    spark = (
        SparkSession.builder.appName("quillwatch")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    feeds = Feeds(a.revisions, a.entities, a.pageviews, a.topics, a.pretty, a.xml)
    for kind in KINDS:
        if path := getattr(a, f"{kind}_replies"):
            with scratch(spark):
                add_replies(spark, feeds, kind, spark.read.parquet(path))
    if a.current:
        follow_current(spark, feeds, a.out).show(100, False)
    elif a.follow:
        follow(spark, feeds, a.out).show(100, False)
    else:
        run(spark, feeds, a.out, a.timeline, a.max_revisions, a.top_editors or None).show(100, False)


if __name__ == "__main__":
    main()
