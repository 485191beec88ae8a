import datetime as dt

import pytest
from conftest import at, later
from pyspark.sql import functions as F

from quillwatch.operators import charts, cleaning, episodes, features, topics


@pytest.fixture
def sample(revisions):
    return revisions(
        [
            ("A", 1, "x", at("2024-01-01T00:00:00"), 100),
            ("A", 3, "y", at("2024-01-03T12:00:00"), 150, True),
            ("A", 2, "x", at("2024-01-03T12:00:00"), 90),  # same time: revid decides
            ("A", 4, None, at("2024-01-10T23:00:00"), None),
            ("A", 5, "ip1", at("2024-01-11T00:00:00"), 40),
            ("B", 6, "x", at("2024-02-01T00:00:00"), 33),
        ]
    )


def test_article_metrics(sample):
    a, b = features.article_metrics(sample).orderBy("article_title").collect()
    # 100, 90-100, 150-90, unknown, 40-0
    assert a.avg_content_change == pytest.approx((100 + 10 + 60 + 40) / 4)
    assert (a.total_edits, a.unique_editors, a.revert_count, a.active_days) == (5, 3, 1, 11)
    assert a.edit_velocity == pytest.approx(5 / 11) and a.reversion_rate == pytest.approx(0.2)
    assert (a.first_edit, a.last_edit) == (at("2024-01-01T00:00:00"), at("2024-01-11T00:00:00"))
    assert (b.total_edits, b.active_days, b.edit_velocity, b.editor_diversity) == (1, 1, 1.0, 0.0)
    assert b.avg_content_change == 33


def test_metrics_do_not_depend_on_slicing(sample):
    whole = features.article_metrics(sample).orderBy("article_title").collect()
    assert features.article_metrics(sample, tasks=7).orderBy("article_title").collect() == whole


def test_gap_median(sample):
    got = {r.article_title: r.median_gap_seconds for r in features.time_between_revisions(sample).collect()}
    gaps = sorted([216_000, 0, 644_400, 3_600])
    assert got == {"A": (gaps[1] + gaps[2]) / 2, "B": None}
    sliced = features.time_between_revisions(sample, tasks=7)
    assert {r.article_title: r.median_gap_seconds for r in sliced.collect()} == got


def test_anonymous_share(sample):
    got = {r.article_title: r.anon_editor_pct for r in features.anon_editor_pct(sample).collect()}
    assert got == {"A": pytest.approx(0.4), "B": 0.0}


def test_joined_features_and_defaults(spark, sample):
    entities = spark.createDataFrame(
        [("A", "political", None, 7)],
        "article_title STRING, topic_category STRING, claims_count INT, sitelinks_count INT",
    )
    views = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), 10), ("A", dt.date(2024, 1, 2), 30), ("C", dt.date(2024, 1, 1), 5)],
        "article_title STRING, view_date DATE, views BIGINT",
    )
    traffic = features.pageview_features(views)
    lone = traffic.filter("article_title = 'C'").first()
    assert lone.views_stddev is None and lone.pageview_spike_ratio == 1.0
    joined = features.fill_defaults(features.join_features(features.article_metrics(sample), entities, traffic))
    a, b = joined.orderBy("article_title").collect()
    assert (a.topic_category, a.claims_count, a.sitelinks_count, a.total_views, a.peak_daily_views) == ("political", 0, 7, 40, 30)
    assert a.pageview_spike_ratio == 1.5 and a.views_stddev == pytest.approx(14.1421356)
    assert (b.topic_category, b.total_views, b.views_stddev, b.pageview_spike_ratio) == ("unknown", 0, 0.0, 1.0)
    assert len(joined.columns) == 19


def test_spike_ratio_of_rare_views(spark):
    views = spark.createDataFrame([("A", 0), ("A", 1)], "article_title STRING, views BIGINT")
    assert features.pageview_features(views).first().pageview_spike_ratio == 1.0


def test_last_topic_list_wins(spark):
    lists = spark.createDataFrame(
        [("A", "political", 1), ("A", "cultural", 3), ("B", "scientific", 2)],
        "article_title STRING, topic_category STRING, list_order INT",
    )
    dimension = cleaning.topic_dimension(lists)
    titles = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "article_title STRING")
    got = {r.article_title: r.topic_category for r in cleaning.assign_topic(titles, dimension).collect()}
    assert got == {"A": "cultural", "B": "scientific", "C": "unknown", None: "unknown"}


def test_new_keys(spark):
    incoming = spark.createDataFrame([("A",), ("B",), ("B",)], "article_title STRING")
    stored = spark.createDataFrame([("A",)], "article_title STRING")
    assert [r.article_title for r in cleaning.new_keys(incoming, stored).collect()] == ["B"]


@pytest.fixture
def weeks(revisions):
    rows, revid = [], 0

    def week(title, start, edits, reverts):
        nonlocal revid
        for i in range(edits):
            revid += 1
            rows.append((title, revid, f"u{i % 4}", later(i * 3600, start), 1, i < reverts))

    week("A", "2024-01-01T00:00:00", 10, 4)  # edit war
    week("A", "2024-01-08T00:00:00", 10, 3)  # rate exactly 0.3: not above
    week("A", "2024-01-15T00:00:00", 9, 9)  # too few edits
    week("B", "2024-01-01T00:00:00", 20, 7)  # edit war
    return revisions(rows)


def test_weekly_and_edit_wars(spark, weeks):
    weekly = episodes.weekly_edit_stats(weeks)
    assert weekly.agg(F.sum("weekly_edits")).first()[0] == weeks.count()
    wars = episodes.edit_wars(weekly)
    lookup = spark.createDataFrame([("A", "political"), ("A", "political")], "article_title STRING, topic_category STRING")
    got = episodes.edit_wars_by_topic(wars, lookup).collect()
    assert [(r.article_title, str(r.week_start), r.weekly_edits, r.weekly_reverts, r.weekly_editors, r.topic_category) for r in got] == [
        ("A", "2024-01-01", 10, 4, 4, "political"),
        ("B", "2024-01-01", 20, 7, 4, None),
    ]
    assert "topic_category" not in episodes.edit_wars_by_topic(wars).columns


def test_timeline_falls_back_to_longest_history(weeks):
    weekly = episodes.weekly_edit_stats(weeks)
    assert {r.article_title for r in episodes.article_timeline(weekly, "B").collect()} == {"B"}
    rows = episodes.article_timeline(weekly, "Missing").collect()
    assert [(r.article_title, str(r.week_start)) for r in rows] == [
        ("A", "2024-01-01"), ("A", "2024-01-08"), ("A", "2024-01-15"),
    ]


def test_topic_tables(spark):
    rows = [("A", "political", 0.2, 1.0, 4, 0.5, 10, 2.0, 1.0), ("B", "political", 0.4, 3.0, 6, 0.7, 20, 4.0, 3.0), ("C", "unknown", 0.9, 9.0, 9, 0.9, 9, 9.0, 9.0)]
    df = spark.createDataFrame(
        rows,
        "article_title STRING, topic_category STRING, reversion_rate DOUBLE, edit_velocity DOUBLE, unique_editors BIGINT, "
        "editor_diversity DOUBLE, total_edits BIGINT, avg_daily_views DOUBLE, pageview_spike_ratio DOUBLE",
    )
    (row,) = topics.topic_comparison(df).collect()
    assert row.article_count == 2 and row.avg_reversion_rate == pytest.approx(0.3) and row.avg_spike_ratio == 2.0
    chart = charts.topic_chart_stats(df).collect()
    assert [r.topic_category for r in chart] == ["political", "scientific", "cultural"]
    assert chart[0].avg_edit_velocity == 2.0 and chart[1].avg_edit_velocity is None
    scores = {r.article_title: r.stability_score for r in charts.stability_score(df).collect()}
    assert scores == {"A": pytest.approx(0.8), "B": pytest.approx(0.6)}


def test_only_used_columns_are_written_to_be_ordered(spark, revisions, monkeypatch):
    from quillwatch.operators import sequences

    written, write = [], sequences.materialize
    monkeypatch.setattr(sequences, "materialize", lambda df, name: written.append(df.columns) or write(df, name))
    table = revisions([("A", 1, "u", at("2024-01-01T00:00:00")), ("A", 2, "v", at("2024-01-02T00:00:00"))])
    table = table.withColumns({"comment": F.lit("long"), "parentid": F.lit(1)})
    assert features.article_metrics(table).first().total_edits == 2
    assert features.time_between_revisions(table).first().median_gap_seconds == 86400
    assert len(written) == 2 and not any({"comment", "parentid", "userid"} & set(c) for c in written)
