"""Every operator as a query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillwatch.functions import revert_flag, safe_title
from quillwatch.operators import (
    charts, cleaning, coediting, episodes, features, graph, models, quality, sequences, stability, topics,
)
from quillwatch.plans import bindings as b
from quillwatch.session import fresh_path, materialize
from quillwatch.sources import manifest, paging, raw, replies, sinks
from quillwatch.streaming import current
from quillwatch.streaming import weekly as stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TIMELINE_TARGET = "No such article"
PRESENT_TARGET = "A7"
SHORT_CAP = 50


def query(name: str):
    """Register under ``name``. Fractions are rounded to six places, so that a different
    order of additions does not show; times are given without a zone, like the test tables."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = f(spark, folder)
            shown = {n: F.round(n, 6) for n, t in df.dtypes if t == "double"}
            shown |= {n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"}
            return df.withColumns(shown) if shown else df

        QUERIES[name] = run
        return f

    return register


# Scans and sources


@query("scan_revisions")
def _(spark, folder):
    records = b.raw_revisions(spark, folder)
    path = b.write_array_lines(records, F.floor(F.col("revid") / b.BATCH), "revisions")
    return raw.scan_revisions(spark, path)


@query("scan_entities")
def _(spark, folder):
    path = fresh_path(spark, "entities")
    b.raw_entities(spark, folder).write.json(path)
    return raw.scan_entities(spark, path).withColumns(
        {"instance_of": F.array_join("instance_of", ","), "part_of": F.array_join("part_of", ",")}
    )


@query("scan_pageviews")
def _(spark, folder):
    records = b.raw_pageviews(spark, folder)
    batch = F.hash("article_title", F.substring("timestamp", 1, 6))
    return raw.scan_pageviews(spark, b.write_array_lines(records, batch, "pageviews"))


@query("scan_parquet")
def _(spark, folder):
    return b.table(spark, folder, "events").select("event_id", "user_id", "event_type")


@query("dim_topics")
def _(spark, folder):
    return cleaning.topic_dimension(b.curated_topics(spark, folder))


@query("flatten_revision_api")
def _(spark, folder):
    return replies.flatten_revisions(b.revision_replies(spark, folder))


@query("flatten_paged_revisions")
def _(spark, folder):
    return paging.flatten_paged_revisions(b.paged_replies(spark, folder)).drop("comment", "user", "userid")


@query("paging_report")
def _(spark, folder):
    return paging.paging_report(paging.chained(paging.read_pages(b.paged_replies(spark, folder))))


@query("flatten_entity_api")
def _(spark, folder):
    return replies.flatten_entities(b.entity_replies(spark, folder)).drop("instance_of", "part_of")


@query("extract_claims")
def _(spark, folder):
    found = replies.flatten_entities(b.entity_replies(spark, folder))
    both = F.array(
        F.struct(F.lit("P31").alias("property"), F.col("instance_of").alias("ids")),
        F.struct(F.lit("P361").alias("property"), F.col("part_of").alias("ids")),
    )
    return found.select("article_title", F.explode(both).alias("c")).select(
        "article_title", "c.property", F.array_join("c.ids", ",").alias("ids")
    )


@query("flatten_pageview_api")
def _(spark, folder):
    return replies.flatten_pageviews(b.pageview_replies(spark, folder))


@query("cap_revisions")
def _(spark, folder):
    kept = cleaning.cap_revisions(b.revisions(spark, folder))
    return kept.select("article_title", "revid", "edit_timestamp")


@query("cap_revisions_short")
def _(spark, folder):
    """A cap that is reached by articles of small tables, too."""
    kept = cleaning.cap_revisions(b.revisions(spark, folder), SHORT_CAP)
    return kept.select("article_title", "revid", "edit_timestamp")


@query("incremental_new_keys")
def _(spark, folder):
    return cleaning.new_keys(b.raw_entities(spark, folder), b.revisions(spark, folder))


# Titles with characters that file names and addresses write differently.
_ODD_TITLE = "100% {}: why?"


def _raw_by_title(spark, folder, title: str = "{}") -> str:
    path = fresh_path(spark, "raw")
    before, after = title.split("{}")
    records = b.raw_revisions(spark, folder)
    titled = records.withColumn("article_title", F.concat(F.lit(before), "article_title", F.lit(after)))
    sinks.write_raw_by_title(titled, path)
    return path


@query("ingest_counts")
def _(spark, folder):
    counts = raw.ingest_counts(spark, _raw_by_title(spark, folder, _ODD_TITLE), "revid")
    # Encoded once as the name of a folder and once more as an address.
    title = F.url_decode(F.url_decode(F.regexp_extract("file", "safe_title=([^/]+)/", 1)))
    return counts.groupBy(title.alias("safe_title")).agg(
        F.sum("records").alias("records"), F.sum("keyed_records").alias("keyed_records"), F.sum("unreadable").alias("unreadable")
    )


@query("file_manifest")
def _(spark, folder):
    # Each line is a title and takes one byte more than its text.
    path = fresh_path(spark, "titles")
    b.raw_revisions(spark, folder).select(F.col("article_title").alias("value")).write.text(path)
    manifest = raw.file_manifest(spark, {"titles": path})
    return manifest.groupBy("dataset").agg(
        F.sum("length").alias("bytes"), (F.count_distinct("path") == F.count_distinct("file")).alias("files_named")
    )


def _titles_manifest(spark, folder, kept, doubled) -> DataFrame:
    """The files of a folder with a part per title; a doubled title holds its records twice."""
    path = fresh_path(spark, "titles")
    records = b.raw_revisions(spark, folder).filter(kept).select("article_title", "pageid", "revid")
    again = records.filter(doubled)
    records.unionByName(again).select("article_title", F.col("revid").cast("string")).write.partitionBy("article_title").text(path)
    files = raw.file_manifest(spark, {"titles": path})
    title = F.regexp_extract("file", "article_title=([^/]+)/", 1)
    return files.groupBy("dataset", title.alias("path")).agg(F.sum("length").alias("length"), F.lit(None).cast("timestamp").alias("modified"))


@query("manifest_changes")
def _(spark, folder):
    page = F.col("pageid")
    before = _titles_manifest(spark, folder, page % 4 != 0, F.lit(False))
    now = _titles_manifest(spark, folder, page % 5 != 0, page % 3 == 0)
    return manifest.changes(before, now).select("path", "change", "length")


@query("scan_xml_dump")
def _(spark, folder):
    records = b.raw_revisions(spark, folder)
    person = F.struct(F.col("user").alias("username"), F.col("userid").alias("id"))
    revision = F.struct(
        F.col("revid").alias("id"),
        "parentid",
        "timestamp",
        person.alias("contributor"),
        "comment",
        F.struct(F.col("size").alias("_bytes"), F.lit("").alias("_VALUE")).alias("text"),
    )
    path = fresh_path(spark, "dump")
    (
        records.groupBy("article_title", "pageid", F.floor(F.col("revid") / b.BATCH).alias("_batch"))
        .agg(F.collect_list(revision).alias("revision"))
        .select(F.col("article_title").alias("title"), F.col("pageid").alias("id"), "revision")
        .write.format("xml")
        .option("rowTag", "page")
        .option("rootTag", "mediawiki")
        .save(path)
    )
    return raw.scan_xml_dump(spark, path)


# Sinks


@query("sink_parquet")
def _(spark, folder):
    return sinks.write_parquet(b.article_features(spark, folder), fresh_path(spark, "features"))


@query("sink_partitioned_raw")
def _(spark, folder):
    back = spark.read.schema("revid BIGINT, article_title STRING, safe_title STRING").json(
        _raw_by_title(spark, folder)
    )
    return back.select("safe_title", "article_title", "revid")


def _collections(spark, folder) -> dict[str, DataFrame]:
    table = materialize(b.article_features(spark, folder), "features")
    predictions = stability.predictions_union(
        {name: b.fixed_predictions(spark, folder, name) for name in ("first", "second")}
    )
    return {
        "article_edit_metrics": table,
        "editor_network_metrics": graph.network_metrics(_edges(spark, folder)),
        "stability_predictions": predictions,
        "topic_comparison": topics.topic_comparison(table),
    }


@query("publish_documents")
def _(spark, folder):
    collections = {**_collections(spark, folder), "not_computed": None}
    return sinks.publish_documents(spark, collections, fresh_path(spark, "documents"))


@query("document_store")
def _(spark, folder):
    """A collection replaced twice and read back: the documents of the second table, and as many as were told."""
    store = fresh_path(spark, "store")
    table = materialize(b.article_features(spark, folder), "features")
    wars = episodes.edit_wars(b.weekly(spark, folder))
    for shown in (wars, table):
        told = sinks.publish_documents(spark, {"articles": shown}, store, format="documents")
    document = F.from_json("value", "article_title STRING, total_edits BIGINT, topic_category STRING")
    back = spark.read.format("documents").option("collection", "articles").load(store).select(document.alias("d"))
    return back.select("d.*", F.lit(told.first().documents).cast("bigint").alias("documents"))


@query("predictions_union")
def _(spark, folder):
    both = stability.predictions_union(
        {name: b.fixed_predictions(spark, folder, name) for name in ("first", "second")}
    )
    return both.select(
        "model",
        "article_title",
        "stability_label",
        "prediction",
        F.col("probability")[0].alias("p_stable"),
        F.col("probability")[1].alias("p_unstable"),
    )


# Projections and filters


@query("clean_revisions")
def _(spark, folder):
    return cleaning.clean_revisions(b.raw_revisions(spark, folder))


@query("revert_flag")
def _(spark, folder):
    return b.table(spark, folder, "documents").select("doc_id", revert_flag("text").alias("is_revert"))


@query("clean_pageviews")
def _(spark, folder):
    return cleaning.clean_pageviews(b.raw_pageviews(spark, folder))


@query("clean_entities")
def _(spark, folder):
    return b.entities(spark, folder)


@query("filter_named_humans")
def _(spark, folder):
    return coediting.named_edits(b.revisions(spark, folder))


@query("filter_edit_war")
def _(spark, folder):
    return episodes.edit_wars(b.weekly(spark, folder))


@query("filter_known_topics")
def _(spark, folder):
    return topics.known_topics(b.article_features(spark, folder)).select("article_title", "topic_category")


@query("stability_label")
def _(spark, folder):
    labelled = stability.with_label(b.article_metrics(spark, folder))
    return labelled.select("article_title", "reversion_rate", "stability_label")


@query("stability_label_median")
def _(spark, folder):
    metrics = materialize(b.article_metrics(spark, folder).select("article_title", "reversion_rate"), "rates")
    return stability.with_median_label(metrics)


@query("stability_score")
def _(spark, folder):
    return charts.stability_score(b.article_features(spark, folder))


@query("fill_defaults")
def _(spark, folder):
    return b.article_features(spark, folder).select("article_title", *features.DEFAULTS)


@query("title_display")
def _(spark, folder):
    return charts.titles_for_display(
        b.entities(spark, folder).withColumn("article_title", F.concat_ws("_", "article_title", "label"))
    )


@query("safe_title")
def _(spark, folder):
    return b.table(spark, folder, "pages").select("page_id", safe_title("url").alias("safe_title"))


@query("article_timeline_of")
def _(spark, folder):
    return episodes.article_timeline(b.weekly(spark, folder), PRESENT_TARGET)


@query("article_timeline")
def _(spark, folder):
    return episodes.article_timeline(b.weekly(spark, folder), TIMELINE_TARGET)


# Joins


@query("join_features")
def _(spark, folder):
    return b.joined_features(spark, folder)


@query("assign_topic")
def _(spark, folder):
    titles = b.revisions(spark, folder).select("article_title", "revid")
    return cleaning.assign_topic(titles, cleaning.topic_dimension(b.curated_topics(spark, folder)))


@query("topk_editor_filter")
def _(spark, folder):
    return coediting.of_top_editors(coediting.named_edits(b.revisions(spark, folder)))


@query("coedit_pairs")
def _(spark, folder):
    return coediting.coedit_pairs(coediting.of_top_editors(coediting.named_edits(b.revisions(spark, folder))))


def _edges(spark, folder) -> DataFrame:
    return materialize(b.edges(spark, folder), "edges")


@query("edge_neighbour_join")
def _(spark, folder):
    joined = graph.edge_neighbours(_edges(spark, folder))
    return joined.select(
        "editor_a",
        "editor_b",
        F.array_join("neighbors_a", ",").alias("neighbors_a"),
        F.array_join("neighbors_b", ",").alias("neighbors_b"),
    )


@query("degree_triangle_join")
def _(spark, folder):
    return graph.degree_with_triangles(_edges(spark, folder))


@query("edit_wars_topic")
def _(spark, folder):
    return episodes.edit_wars_by_topic(
        episodes.edit_wars(b.weekly(spark, folder)), b.article_features(spark, folder)
    )


@query("topic_lookup")
def _(spark, folder):
    return episodes.topic_lookup(b.article_features(spark, folder))


# Aggregations and windows


@query("article_metrics")
def _(spark, folder):
    return b.article_metrics(spark, folder)


@query("editor_diversity")
def _(spark, folder):
    return features.diversity(b.revisions(spark, folder))


@query("length_change")
def _(spark, folder):
    return sequences.length_change(b.revisions(spark, folder)).select(
        "article_title", "revid", "prev_length", "length_change"
    )


@query("pageview_features")
def _(spark, folder):
    return features.pageview_features(b.pageviews(spark, folder))


@query("editor_activity")
def _(spark, folder):
    return coediting.editor_activity(coediting.named_edits(b.revisions(spark, folder)))


@query("top_editors")
def _(spark, folder):
    return coediting.top_editors(coediting.named_edits(b.revisions(spark, folder)))


@query("coediting_edges")
def _(spark, folder):
    return b.edges(spark, folder)


@query("coedit_graph")
def _(spark, folder):
    return coediting.coedit_graph(b.revisions(spark, folder))


@query("top_edges")
def _(spark, folder):
    return charts.top_edges(b.edges(spark, folder))


@query("symmetric_adjacency")
def _(spark, folder):
    return graph.symmetric_adjacency(b.edges(spark, folder))


@query("editor_degree")
def _(spark, folder):
    return graph.editor_degree(graph.symmetric_adjacency(b.edges(spark, folder)))


@query("neighbour_lists")
def _(spark, folder):
    lists = graph.neighbour_lists(graph.symmetric_adjacency(b.edges(spark, folder)))
    return lists.withColumn("neighbors", F.array_join("neighbors", ","))


# Pages of few names, so that editors of small tables have several.
SHORT_PAGE = 7


@query("neighbour_pages")
def _(spark, folder):
    pages = graph.neighbour_pages(graph.symmetric_adjacency(b.edges(spark, folder)), SHORT_PAGE)
    return pages.select("editor", "page", F.array_join("neighbors", ",").alias("neighbors"), F.size("neighbors").alias("names"))


@query("edge_neighbour_pages")
def _(spark, folder):
    joined = graph.edge_neighbour_pages(_edges(spark, folder), SHORT_PAGE)
    return joined.select("editor_a", "editor_b", "page", *[F.array_join(f"neighbors_{s}", ",").alias(f"neighbors_{s}") for s in ("a", "b")])


@query("common_neighbours")
def _(spark, folder):
    return graph.common_neighbours(_edges(spark, folder))


@query("editor_triangles")
def _(spark, folder):
    return graph.editor_triangles(_edges(spark, folder))


@query("clustering_coefficient")
def _(spark, folder):
    return graph.network_metrics(_edges(spark, folder)).select("editor", "clustering_coefficient")


@query("network_metrics")
def _(spark, folder):
    return graph.network_metrics(_edges(spark, folder))


@query("graph_summary")
def _(spark, folder):
    return charts.graph_summary(materialize(charts.top_edges(b.edges(spark, folder)), "top-edges"))


@query("top_degree_labels")
def _(spark, folder):
    return charts.top_degree_labels(materialize(charts.top_edges(b.edges(spark, folder)), "top-edges"))


@query("weekly_edit_stats")
def _(spark, folder):
    return b.weekly(spark, folder)


@query("weeks_per_article")
def _(spark, folder):
    return episodes.weeks_per_article(b.weekly(spark, folder))


@query("topic_comparison")
def _(spark, folder):
    return topics.topic_comparison(b.article_features(spark, folder))


@query("topic_chart_stats")
def _(spark, folder):
    return charts.topic_chart_stats(b.article_features(spark, folder))


@query("anon_editor_pct")
def _(spark, folder):
    return features.anon_editor_pct(b.revisions(spark, folder))


@query("time_between_revisions")
def _(spark, folder):
    return features.time_between_revisions(b.revisions(spark, folder))


# Classification


@query("label_distribution")
def _(spark, folder):
    return stability.label_distribution(stability.with_label(b.article_metrics(spark, folder)))


@query("topic_index")
def _(spark, folder):
    known = b.entities(spark, folder).select("article_title", "topic_category")
    return stability.topic_indexer().fit(known).transform(known)


@query("feature_vector")
def _(spark, folder):
    labelled = materialize(stability.with_label(b.article_features(spark, folder)), "labelled")
    values = F.posexplode(vector_to_array("features")).alias("position", "value")
    return stability.feature_vectors(labelled).select("article_title", "stability_label", values)


@query("train_test_split")
def _(spark, folder):
    return stability.with_split(b.entities(spark, folder).select("article_title"))


def _train_and_test(spark, folder) -> tuple[DataFrame, DataFrame]:
    labelled = materialize(stability.with_label(b.article_features(spark, folder)), "labelled")
    # Written once: counting, ordering and fitting each read them.
    return stability.train_test_split(materialize(stability.feature_vectors(labelled), "vectors"))


# A fitted model has no counterpart in SQL. What SQL can state is who is held out, with which
# label, and what has to hold of every prediction, ranking and score.


def _sound_predictions(model, test: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    return stability.predictions_of(model, test).select(
        "article_title",
        "stability_label",
        (F.col("prediction") == F.when(p[1] > p[0], 1.0).otherwise(0.0)).alias("predicts_the_likelier"),
        (F.abs(p[0] + p[1] - 1) < 1e-9).alias("adds_up"),
    )


@query("rf_classifier")
def _(spark, folder):
    train, test = _train_and_test(spark, folder)
    return _sound_predictions(stability.fit_forest(train), test)


@query("lr_classifier")
def _(spark, folder):
    train, test = _train_and_test(spark, folder)
    return _sound_predictions(stability.fit_regression(train), test)


@query("feature_importance")
def _(spark, folder):
    train, _ = _train_and_test(spark, folder)
    found = materialize(stability.feature_importance(stability.fit_forest(train), spark), "importance")
    order = Window.orderBy("rank")
    total = F.sum("importance").over(Window.partitionBy())
    return found.select(
        "rank",
        (F.col("importance") >= 0).alias("not_negative"),
        (F.col("importance") <= F.coalesce(F.lag("importance").over(order), F.lit(1.0))).alias("in_order"),
        ((F.abs(total - 1) < 1e-9) | (total == 0)).alias("adds_up"),
        (F.count(F.when(F.col("feature").isin(*stability.FEATURES), 1)).over(Window.partitionBy("feature")) == 1).alias("one_feature"),
    )


@query("forest_replay")
def _(spark, folder):
    """Predictions of the model against walking down the trees of its table of nodes."""
    train, test = _train_and_test(spark, folder)
    forest = stability.fit_forest(train)
    nodes = materialize(models.forest_nodes(forest, spark), "nodes")
    replayed = models.replay_forest(test, nodes, stability.FOREST["maxDepth"]).select(
        "article_title", F.col("probability").alias("again"), F.col("prediction").alias("predicted")
    )
    told = stability.predictions_of(forest, test).withColumn("p", vector_to_array("probability"))
    same = [F.abs(F.col("p")[i] - F.col("again")[i]) < 1e-9 for i in (0, 1)]
    return told.join(replayed, "article_title", "left").select(
        "article_title", "stability_label", (same[0] & same[1]).alias("same_probability"),
        # A tie of half and half may be told either way by the last digit of a sum.
        ((F.col("prediction") == F.col("predicted")) | (F.abs(F.col("p")[0] - 0.5) < 1e-9)).alias("same_prediction"),
    )


@query("forest_importance")
def _(spark, folder):
    """Importances of the model against those summed up over its table of nodes."""
    train, _ = _train_and_test(spark, folder)
    forest = stability.fit_forest(train)
    told = stability.feature_importance(forest, spark).select("feature", F.col("importance").alias("told"))
    summed = models.importance_of(materialize(models.forest_nodes(forest, spark), "nodes"))
    return summed.join(told, "feature").select("feature", (F.abs(F.col("told") - F.col("importance")) < 1e-9).alias("same_importance"))


@query("regression_optimality")
def _(spark, folder):
    """That every coefficient is at the minimum of the loss, to the tolerance of the fit."""
    train, _ = _train_and_test(spark, folder)
    fitted = stability.fit_regression(train)
    gaps = models.optimality(train, models.coefficient_table(fitted, spark))
    return gaps.select("place", "feature", (F.col("gap") < fitted.getTol()).alias("at_minimum"))


@query("model_metrics")
def _(spark, folder):
    """Scores of the evaluators against the same scores by counting."""
    train, test = _train_and_test(spark, folder)
    forest, regression = stability.fit_forest(train), stability.fit_regression(train)
    told = {
        name: materialize(stability.predictions_of(m, test), "predictions")
        for name, m in (("random_forest", forest), ("logistic_regression", regression))
    }
    scores = {name: stability.evaluate(p) for name, p in told.items()}
    metrics = stability.model_metrics(scores, stability.feature_importance(forest, spark))
    written = sinks.write_metrics(metrics, fresh_path(spark, "metrics"))
    rows = None
    for name, p in told.items():
        scored = p.select("stability_label", vector_to_array("rawPrediction")[1].alias("score"))
        counted = {c: stability.accuracy_and_f1(p).select(c).scalar() for c in ("accuracy", "f1")}
        counted["auc"] = stability.area_under_roc(scored).scalar()
        agrees = [
            F.coalesce(F.abs(F.col(c) - value) < 1e-9, value.isNull()).alias(f"{c}_agrees") for c, value in counted.items()
        ]
        one = written.filter(F.col("model") == name).select("model", *agrees, F.size("feature_importance").alias("ranked"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("probability_list")
def _(spark, folder):
    listed = b.fixed_predictions(spark, folder, "first").select(
        "article_title", F.posexplode(vector_to_array("probability")).alias("class", "probability")
    )
    return listed


@query("evaluate_auc")
def _(spark, folder):
    return stability.area_under_roc(b.scored(spark, folder))


@query("evaluate_accuracy_f1")
def _(spark, folder):
    return stability.accuracy_and_f1(b.scored(spark, folder))


@query("confusion_matrix")
def _(spark, folder):
    return stability.confusion_matrix(b.scored(spark, folder))


@query("roc_points")
def _(spark, folder):
    return charts.roc_points(b.scored(spark, folder))


# Checks


def _outputs(spark, folder) -> dict[str, DataFrame]:
    return {
        "revisions_clean": b.revisions(spark, folder),
        "entities_clean": b.entities(spark, folder),
        "pageviews_clean": b.pageviews(spark, folder),
        "article_features": b.article_features(spark, folder),
        "weekly_edit_stats": b.weekly(spark, folder),
        "edit_wars": episodes.edit_wars(b.weekly(spark, folder)),
    }


@query("collection_counts")
def _(spark, folder):
    return quality.with_total(quality.table_counts(_outputs(spark, folder)))


@query("dq_min_files")
def _(spark, folder):
    # The number of files follows from the number of write tasks, whatever the size of the tables.
    paths = {name: fresh_path(spark, name) for name in ("revisions", "entities")}
    b.raw_revisions(spark, folder).repartition(12).write.json(paths["revisions"])
    b.raw_entities(spark, folder).repartition(3).write.json(paths["entities"])
    return quality.min_files(raw.file_manifest(spark, paths), [*paths, "none"])


@query("dq_required_field")
def _(spark, folder):
    records = b.raw_revisions(spark, folder)
    return quality.required_field(records, "revid").unionByName(quality.required_field(records, "comment"))


@query("dq_outputs_present")
def _(spark, folder):
    return quality.outputs_present(_outputs(spark, folder))


@query("dq_collection_counts")
def _(spark, folder):
    counts = quality.table_counts(_collections(spark, folder))
    return quality.at_least(counts, "collection", 1)


@query("dq_unique")
def _(spark, folder):
    return quality.unique_key(b.entities(spark, folder), "article_title", "entities").unionByName(
        quality.unique_key(b.revisions(spark, folder), "user", "revisions")
    )


@query("dq_complete")
def _(spark, folder):
    path = _raw_by_title(spark, folder)
    totals = materialize(raw.totals_of(raw.feed_counts(spark, {"revisions": (path, "revid")})), "totals")
    clean = cleaning.clean_revisions(raw.scan_revisions(spark, path))
    checks = quality.complete(totals, quality.table_counts({"revisions": clean}))
    for check in (quality.keyed, quality.readable, quality.not_silent):
        checks = checks.unionByName(check(totals))
    return checks


@query("dq_models")
def _(spark, folder):
    train, test = _train_and_test(spark, folder)
    forest = stability.fit_forest(train)
    scores = {"random_forest": stability.evaluate(stability.predictions_of(forest, test))}
    metrics = stability.model_metrics(scores, stability.feature_importance(forest, spark))
    return quality.models_measured(metrics, len(stability.FEATURES))


@query("dq_summary")
def _(spark, folder):
    records = b.raw_revisions(spark, folder)
    checks = quality.outputs_present(_outputs(spark, folder))
    checks = checks.unionByName(quality.required_field(records, "revid"))
    return quality.summary(checks.unionByName(quality.required_field(records, "comment")))


# Streaming


@query("stream_weekly_edit_wars")
def _(spark, folder):
    schema = b.table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")
    return episodes.edit_wars(stream.run_available(stream.weekly_edit_stream(b.as_revisions(events))))


def _followed(spark, folder) -> str:
    """A store that has followed the edits in two steps, a third of them in the second."""
    events, store, log = b.table(spark, folder, "events"), None, fresh_path(spark, "log")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        events.filter(part).write.mode("append").parquet(log)
        store = current.follow(b.as_revisions(spark.readStream.schema(events.schema).parquet(log)), store)
    return store


@query("stream_current_weeks")
def _(spark, folder):
    return current.weeks(spark, _followed(spark, folder))


@query("stream_late_edits")
def _(spark, folder):
    return current.set_apart(spark, _followed(spark, folder)).select("article_title", "revid", "edit_timestamp", "reason", "batch")


@query("stream_totals")
def _(spark, folder):
    store = _followed(spark, folder)
    current.compact(spark, store)
    counted = current.weeks(spark, store).groupBy("closed").agg(F.sum("weekly_edits").alias("edits"))
    state = F.when(F.col("closed"), "closed").otherwise("open").alias("state")
    total = current.totals(spark, store)
    return (
        counted.select(state, "edits")
        .unionByName(total.select(F.lit("apart").alias("state"), F.col("apart").alias("edits")))
        .unionByName(total.select(F.lit("all").alias("state"), "edits"))
    )
