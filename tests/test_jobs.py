import json
import random

import pytest
from conftest import later

from quillwatch import session
from quillwatch.plans import jobs


def feed(folder, title, content):
    folder.mkdir(exist_ok=True)
    (folder / f"{title}.json").write_text(json.dumps(content))


@pytest.fixture(scope="module")
def outcome(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("feeds")
    rng = random.Random(9)
    revid = 0
    titles = [f"T{i}" for i in range(40)]
    for i, title in enumerate(titles):
        revisions = []
        for _ in range(rng.randrange(15, 40)):
            revid += 1
            undo = rng.random() < (0.4 if i % 2 else 0.05)
            who = rng.randrange(12)
            revisions.append({
                "revid": revid, "parentid": 0, "user": f"u{who}", "userid": who, "size": rng.randrange(1000),
                "timestamp": later(rng.randrange(20 * 86_400)).isoformat() + "Z",
                "comment": "Reverted edit" if undo else "copy edit", "article_title": title, "pageid": i,
            })
        feed(base / "revisions", title, revisions)
        feed(base / "entities", title, {"qid": f"Q{i}", "article_title": title, "label": title, "description": "", "claims_count": i, "sitelinks_count": 1, "instance_of": [], "part_of": []})
        feed(base / "pageviews", title, [{"timestamp": f"202401{d:02d}00", "views": rng.randrange(90), "article_title": title} for d in range(1, 10)])
    topics = [(t, ("political", "scientific", "cultural")[i % 3], i % 3) for i, t in enumerate(titles)]
    spark.createDataFrame(topics, "article_title STRING, topic_category STRING, list_order INT").write.parquet(str(base / "topics"))
    feeds = jobs.Feeds(*(str(base / n) for n in ("revisions", "entities", "pageviews", "topics")))
    out = str(base / "out")
    return jobs.run(spark, feeds, out).collect(), out, revid, feeds


def test_all_checks_pass(outcome):
    checks, *_ = outcome
    assert {c.outcome for c in checks} == {"PASSED"}
    assert {
        "min_files:pageviews", "required_field:revisions", "readable:entities", "not_silent:revisions", "complete:revisions", "unique:entities.article_title",
        "unique:revisions.revid", "output:edit_wars", "output:model_metrics", "output:random_forest_confusion", "output:label_distribution",
        "model:random_forest", "model:logistic_regression", "collection:topic_comparison",
    } <= {c.check for c in checks}


def test_tables_agree(spark, outcome):
    _, out, revisions, _ = outcome
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("revisions_clean").count() == revisions
    assert read("article_features").agg({"total_edits": "sum"}).first()[0] == revisions
    assert read("weekly_edit_stats").agg({"weekly_edits": "sum"}).first()[0] == revisions
    degrees = read("network_metrics").agg({"degree": "sum"}).first()[0]
    assert degrees == 2 * read("coediting_edges").count() > 0
    ingested = {r.dataset: (r.files, r.records) for r in read("ingest_totals").select("dataset", "files", "records").collect()}
    assert ingested == {"revisions": (40, revisions), "entities": (40, 40), "pageviews": (40, 360)}
    published = {r.collection: r.documents for r in read("published").collect()}
    assert published["article_edit_metrics"] == 40
    assert published["stability_predictions"] == 2 * read("random_forest_predictions").count() > 0
    roc = read("chart_roc_random_forest").collect()
    assert max(r.tpr for r in roc) == 1.0


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_capped_history(spark, outcome, tmp_path):
    *_, feeds = outcome
    tables = jobs.build_features(spark, feeds, str(tmp_path), max_revisions=10)
    assert {r.total_edits for r in tables["article_features"].collect()} == {10}


def test_damage_is_reported(spark, outcome, tmp_path):
    *_, feeds = outcome
    import shutil

    for name in ("revisions", "entities", "pageviews"):
        shutil.copytree(getattr(feeds, name), tmp_path / name)
    (tmp_path / "revisions" / "bad.json").write_text("[{\"revid\": 1}, {")
    feed(tmp_path / "entities", "again", {"qid": "Q0", "article_title": "T0", "label": "", "description": "", "claims_count": 0, "sitelinks_count": 0})
    damaged = jobs.Feeds(*(str(tmp_path / n) for n in ("revisions", "entities", "pageviews")), feeds.topics)
    counts = jobs.ingest(spark, damaged, str(tmp_path / "out"))
    tables = jobs.build_features(spark, damaged, str(tmp_path / "out"))
    bad = {r.check for r in jobs.verify(counts, tables).collect() if r.outcome != "PASSED"}
    assert bad == {"readable:revisions", "unique:entities.article_title"}


def test_replies_add_new_titles_only(spark, tmp_path):
    feeds = jobs.Feeds(*(str(tmp_path / n) for n in ("revisions", "entities", "pageviews", "topics")))
    reply = lambda *ids: json.dumps({"query": {"pages": {"4": {"revisions": [{"revid": i, "parentid": 0, "timestamp": "2024-01-01T00:00:00Z", "user": "u", "userid": 1, "comment": "", "size": 1} for i in ids]}}}})
    ask = lambda *rows: spark.createDataFrame(rows, "article_title STRING, reply STRING")
    found = lambda: sorted((r.article_title, r.revid) for r in jobs.raw.scan_revisions(spark, feeds.revisions).collect())
    jobs.add_replies(spark, feeds, "revisions", ask(("A b", reply(1, 2))))
    assert found() == [("A b", 1), ("A b", 2)]
    for _ in range(2):
        jobs.add_replies(spark, feeds, "revisions", ask(("A b", reply(1, 2, 3)), ("C/d", reply(7))))
        assert found() == [("A b", 1), ("A b", 2), ("C/d", 7)]
    item = {"views": 4, "timestamp": "2024010100", "project": "p", "article": "A b", "granularity": "daily", "access": "a", "agent": "g"}
    for _ in range(2):
        jobs.add_replies(spark, feeds, "pageviews", ask(("A b", json.dumps({"items": [item]}))))
        jobs.add_replies(spark, feeds, "entities", ask(("A b", json.dumps({"entities": {"Q1": {}}}))))
    assert jobs.raw.scan_pageviews(spark, feeds.pageviews).count() == 1 and jobs.raw.scan_entities(spark, feeds.entities).count() == 1


def test_pretty_and_xml_feeds(spark, outcome, tmp_path):
    *_, feeds = outcome
    (tmp_path / "xml").mkdir()
    (tmp_path / "xml" / "d.xml").write_text("<mediawiki><page><title>T1</title><id>1</id><revision><id>5</id><timestamp>2024-01-01T00:00:00Z</timestamp><contributor><username>x</username><id>8</id></contributor><text bytes=\"5\">abcde</text></revision></page></mediawiki>")
    xml = jobs.Feeds(str(tmp_path / "xml"), feeds.entities, feeds.pageviews, feeds.topics, xml=True)
    tables = jobs.build_features(spark, xml, str(tmp_path / "a"))
    assert [(r.article_title, r.total_edits) for r in tables["article_features"].collect()] == [("T1", 1)]
    assert {r.dataset for r in jobs.ingest(spark, xml, str(tmp_path / "a")).select("dataset").distinct().collect()} == {"entities", "pageviews"}
    (tmp_path / "rev").mkdir()
    (tmp_path / "rev" / "a.json").write_text(json.dumps([{"revid": 1, "article_title": "T2", "timestamp": "2024-01-01T00:00:00Z", "user": "u", "userid": 1, "comment": "", "size": 3}], indent=2))
    pretty = jobs.Feeds(str(tmp_path / "rev"), feeds.entities, feeds.pageviews, feeds.topics, pretty=True)
    tables = jobs.build_features(spark, pretty, str(tmp_path / "b"))
    assert [r.article_title for r in tables["article_features"].collect()] == ["T2"]
    assert jobs.ingest(spark, pretty, str(tmp_path / "b")).where("dataset = 'revisions'").first().records == 1


def test_following_the_feed(spark, tmp_path):
    feeds = jobs.Feeds(*(str(tmp_path / n) for n in ("revisions", "entities", "pageviews", "topics")))
    line = lambda i, day: {"revid": i, "article_title": "A", "timestamp": f"2024-01-{day:02d}T00:00:00Z", "user": "u", "userid": 1, "comment": "", "size": 3, "parentid": 0, "pageid": 1}
    feed(tmp_path / "revisions", "one", [line(1, 2), line(2, 3), line(3, 20)])
    first = {str(r.week_start): r.weekly_edits for r in jobs.follow(spark, feeds, str(tmp_path / "out")).collect()}
    feed(tmp_path / "revisions", "two", [line(4, 21), line(5, 31)])
    second = {str(r.week_start): r.weekly_edits for r in jobs.follow(spark, feeds, str(tmp_path / "out")).collect()}
    assert first == {"2024-01-01": 2} and second == {"2024-01-01": 2, "2024-01-15": 2}


def test_intermediate_tables_are_deleted(spark, tmp_path):
    with session.scratch(spark):
        kept = session.materialize(spark.range(3), "x")
        path = session.fresh_path(spark, "y")
        spark.range(2).write.parquet(path)
        assert kept.count() == 3 and session.exists(spark, path)
    assert not session.exists(spark, path)
