import json

import pytest
from pyspark.sql import functions as F

from quillwatch.sources import document_store, raw, replies, sinks


def record(revid, title="A", **extra):
    base = {
        "revid": revid, "parentid": 0, "timestamp": "2022-03-24T00:02:57Z", "user": "x", "userid": 1,
        "comment": "c", "size": 9, "article_title": title, "pageid": 7,
    }
    return {**base, **extra}


def write(folder, name, content):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


def test_arrays_lines_and_damage(spark, tmp_path):
    write(tmp_path, "array.json", [record(1, minor="", anon=""), record(2)])
    write(tmp_path, "lines.json", json.dumps(record(3)) + "\n" + json.dumps(record(4)))
    write(tmp_path, "cut.json", json.dumps([record(5), record(6)])[:-30])
    write(tmp_path, "empty.json", [])
    df = raw.scan_revisions(spark, str(tmp_path / "*.json"))
    assert df.columns == list(record(1))
    assert sorted(r.revid for r in df.dropna(subset=["revid"]).collect()) == [1, 2, 3, 4]


def test_pretty_documents(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps([record(1), record(2)], indent=2))
    assert {r.revid for r in raw.scan_revisions(spark, str(tmp_path), pretty=True).collect()} == {1, 2}


def test_entities_and_pageviews(spark, tmp_path):
    entity = {"qid": "Q1", "article_title": "A", "label": "l", "description": "", "claims_count": 2, "sitelinks_count": 3, "instance_of": ["Q5"], "part_of": []}
    write(tmp_path / "e", "a.json", entity)
    assert raw.scan_entities(spark, str(tmp_path / "e")).first().asDict() == entity
    view = {"project": "p", "article": "A", "granularity": "daily", "timestamp": "2020010100", "access": "a", "agent": "g", "views": 4, "article_title": "A"}
    write(tmp_path / "v", "a.json", [view])
    assert raw.scan_pageviews(spark, str(tmp_path / "v")).first().asDict() == view


def test_ingest_counts(spark, tmp_path):
    write(tmp_path, "array.json", [record(1), record(2), {"other": 1}])
    write(tmp_path, "object.json", record(3))
    write(tmp_path, "broken.json", "[{\"revid\": 1}, {")
    write(tmp_path, "empty.json", "[]")
    got = {r.file.rsplit("/", 1)[1]: (r.records, r.keyed_records, r.unreadable) for r in raw.ingest_counts(spark, str(tmp_path), "revid").collect()}
    assert got == {"array.json": (3, 2, 0), "object.json": (1, 1, 0), "broken.json": (0, 0, 1), "empty.json": (0, 0, 0)}
    totals = raw.ingest_totals(spark, {"revisions": (str(tmp_path), "revid")}).first()
    assert tuple(totals) == ("revisions", 4, 4)
    manifest = raw.file_manifest(spark, {"revisions": str(tmp_path)})
    assert manifest.count() == 4 and manifest.agg({"length": "min"}).first()[0] == 2
    assert "content" not in manifest.columns


def flat(spark, f, *texts):
    return f(spark.createDataFrame([("T", t if isinstance(t, str) else json.dumps(t)) for t in texts], "article_title STRING, reply STRING"))


def test_revision_replies(spark):
    rev = {"revid": 1, "parentid": 0, "timestamp": "t", "user": "u", "userid": 0, "anon": "", "comment": "", "size": 3}
    found = {"query": {"pages": {"42": {"title": "T", "revisions": [rev, {**rev, "revid": 2}]}}}, "continue": {"rvcontinue": "x"}}
    missing = {"query": {"pages": {"-1": {"missing": ""}}}}
    rows = flat(spark, replies.flatten_revisions, found, missing, {"query": {"pages": {"7": {}}}}, "{}", "broken").collect()
    assert [(r.revid, r.pageid, r.article_title, r.userid) for r in rows] == [(1, 42, "T", 0), (2, 42, "T", 0)]


def claim(kind, value):
    return {"mainsnak": {"datavalue": {"type": kind, "value": value}}}


def test_entity_replies(spark):
    full = {"entities": {"Q9": {
        "labels": {"en": {"value": "Label"}}, "descriptions": {}, "sitelinks": {"enwiki": {"title": "T"}, "dewiki": {"title": "T"}},
        "claims": {
            "P31": [claim("wikibase-entityid", {"id": "Q5"}), claim("string", "text"), claim("wikibase-entityid", {}), {"mainsnak": {"snaktype": "novalue"}}],
            "P18": [claim("string", "x"), claim("quantity", {"amount": "+1"})],
        },
    }}}
    bare = {"entities": {"Q8": {}, "Q7": {"labels": {"en": {"value": "second"}}}}}
    rows = flat(spark, replies.flatten_entities, full, bare, {"entities": {"-1": {"missing": ""}}}, {"entities": {"Q1": {"missing": ""}}}, {"entities": {}}, "{}").collect()
    assert [r.asDict() for r in rows] == [
        {"qid": "Q9", "article_title": "T", "label": "Label", "description": "", "claims_count": 2, "sitelinks_count": 2, "instance_of": ["Q5", ""], "part_of": []},
        {"qid": "Q8", "article_title": "T", "label": "T", "description": "", "claims_count": 0, "sitelinks_count": 0, "instance_of": [], "part_of": []},
    ]


def test_pageview_replies(spark):
    item = {"project": "p", "article": "A", "granularity": "daily", "timestamp": "2020010100", "access": "a", "agent": "g", "views": 4}
    rows = flat(spark, replies.flatten_pageviews, {"items": [item, {**item, "views": 5}]}, {"items": []}, {"type": "not found"}).collect()
    assert [(r.views, r.article_title) for r in rows] == [(4, "T"), (5, "T")]


def test_xml_dump(spark, tmp_path):
    write(tmp_path, "dump.xml", """<mediawiki><page><title>Hip hop</title><ns>0</ns><id>3</id>
      <revision><id>10</id><timestamp>2022-03-24T00:02:57Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><text bytes="5">abcde</text></revision>
      <revision><id>11</id><parentid>10</parentid><timestamp>2022-03-25T00:00:00Z</timestamp>
        <contributor><username>x</username><id>8</id></contributor><comment>rv vandalism</comment><text bytes="3">abc</text></revision>
    </page></mediawiki>""")
    got = [tuple(r) for r in raw.scan_xml_dump(spark, str(tmp_path)).orderBy("revid").collect()]
    assert got == [
        (10, None, "2022-03-24T00:02:57Z", "1.2.3.4", 0, None, 5, "Hip_hop", 3),
        (11, 10, "2022-03-25T00:00:00Z", "x", 8, "rv vandalism", 3, "Hip_hop", 3),
    ]


def test_scan_manifest_and_counts_see_the_same_files(spark, tmp_path):
    import gzip

    names = ["with space.json", "pct%20x.json", "é_ü.json", "a+b&c.json", "que?ry.json", "other.txt"]
    for name in names:
        write(tmp_path, name, [record(1), record(2)])
    write(tmp_path / "nested" / "deeper", "n.json", record(3))
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(json.dumps(record(4)).encode()))
    write(tmp_path, "_hidden.json", record(5))
    counts = {r.file: r.records for r in raw.ingest_counts(spark, str(tmp_path), "revid").collect()}
    manifest = raw.file_manifest(spark, {"r": str(tmp_path)}).collect()
    assert sorted(counts.values()) == [1, 1] + [2] * 6
    assert {m.file for m in manifest} == set(counts) and len(manifest) == 8
    assert raw.scan_revisions(spark, str(tmp_path)).count() == sum(counts.values())


def test_titles_that_need_escaping_are_counted(spark, tmp_path):
    titles = ["A: B?", "100% x", "Two words", "Plain", "a/b"]
    df = spark.createDataFrame([(t, i) for t in titles for i in range(3)], "article_title STRING, revid BIGINT")
    sinks.write_raw_by_title(df, str(tmp_path / "raw"))
    assert [r.records for r in raw.ingest_counts(spark, str(tmp_path / "raw"), "revid").collect()] == [3] * 5


def test_a_large_page_is_read_in_splits(spark, tmp_path):
    page = lambda title, number, ids: f"<page><title>{title}</title><ns>0</ns><id>{number}</id>" + "".join(
        f"<revision><id>{i}</id><timestamp>t</timestamp><contributor><ip>x</ip></contributor><text bytes=\"9\">{'y' * 60} &lt;page&gt;</text></revision>\n" for i in ids
    ) + "</page>\n"
    body = "<mediawiki>" + page("First &amp; one", 1, range(5)) + page("Giant", 2, range(100, 3100)) + page("None", 3, []) + page("Last", 4, range(9000, 9003)) + "</mediawiki>"
    write(tmp_path, "dump.xml", body)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "20KB")
    try:
        df = raw.scan_xml_dump(spark, str(tmp_path))
        assert spark.read.option("lineSep", "</revision>").text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = df.collect()
    finally:
        spark.conf.set(setting, before)
    expected = {i: ("First_&_one", 1) for i in range(5)} | {i: ("Giant", 2) for i in range(100, 3100)} | {i: ("Last", 4) for i in range(9000, 9003)}
    assert {r.revid: (r.article_title, r.pageid) for r in got} == expected and len(got) == len(expected)


def test_raw_by_title_replaces_and_survives_odd_names(spark, tmp_path):
    target = str(tmp_path / "raw")
    df = spark.createDataFrame([("AC/DC", 1), ("AC/DC", 2), ("B", 3)], "article_title STRING, revid BIGINT")
    sinks.write_raw_by_title(df, target)
    sinks.write_raw_by_title(df, target)
    back = spark.read.json(target)
    assert sorted((r.safe_title, r.article_title, r.revid) for r in back.collect()) == [("AC_DC", "AC/DC", 1), ("AC_DC", "AC/DC", 2), ("B", "B", 3)]


def test_publish_is_a_full_refresh(spark, tmp_path):
    table = spark.createDataFrame([(1, [0.5, 0.5]), (2, None)], "a INT, b ARRAY<DOUBLE>")
    for rows in (table, table.limit(1)):
        counts = sinks.publish_documents(spark, {"one": rows, "none": None}, str(tmp_path))
        counted = {r.collection: r.documents for r in counts.collect()}
    assert counted == {"one": 1, "none": 0}
    assert json.loads(spark.read.text(f"{tmp_path}/one").first().value) == {"a": 1, "b": [0.5, 0.5]}
    sinks.publish_documents(spark, {"one": table.filter("a = 2")}, str(tmp_path))
    assert json.loads(spark.read.text(f"{tmp_path}/one").first().value) == {"a": 2, "b": None}


def test_publish_through_a_connector(spark, tmp_path):
    table = spark.createDataFrame([(1,)], "a INT")
    counts = sinks.publish_documents(spark, {"one": table}, "", format="json", path=str(tmp_path / "c"))
    assert counts.first().documents == 1 and spark.read.json(str(tmp_path / "c")).first().a == 1


def test_parquet_round_trip(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        assert sinks.write_parquet(df, str(tmp_path / "t")).count() == 3


def test_a_giant_title_spreads_over_files(spark, tmp_path):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "20KB")
    try:
        df = spark.range(0, 60_000, 1, 16).selectExpr("if(id % 3 > 0, 'Giant', concat('A', id % 30)) AS article_title", "id AS revid")
        sinks.write_raw_by_title(df, str(tmp_path / "raw"))
    finally:
        spark.conf.set(setting, before)
    assert len(list((tmp_path / "raw" / "safe_title=Giant").glob("*.json"))) > 3
    assert spark.read.json(str(tmp_path / "raw")).count() == 60_000


def documents_of(spark, folder, name):
    return sorted(r.value for r in spark.read.format("documents").option("collection", name).load(str(folder)).collect())


def failing(spark):
    """Three documents, and a task that fails when it comes to the last."""
    return spark.range(3).repartition(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no such row"))).otherwise(F.col("id")).alias("a"))


def test_a_collection_is_replaced_at_one_moment(spark, tmp_path):
    publish = lambda table: sinks.publish_documents(spark, {"one": table, "none": None}, str(tmp_path), format="documents")
    table = spark.range(100).repartition(7).selectExpr("id AS a", "if(id = 3, NULL, 'x\ny') AS b")
    assert {r.collection: r.documents for r in publish(table).collect()} == {"one": 100, "none": 0}
    first = documents_of(spark, tmp_path, "one")
    assert len(first) == 100 and json.dumps({"a": 3, "b": None}, separators=(",", ":")) in first
    running = spark.read.format("documents").option("collection", "one").load(str(tmp_path))
    assert running.count() == 100
    with pytest.raises(Exception, match="no such row"):
        publish(failing(spark))
    assert documents_of(spark, tmp_path, "one") == first
    assert publish(table.filter("a < 2")).first().documents == 2
    assert running.count() == 100  # a reader that has begun goes on with what it began with
    assert len(documents_of(spark, tmp_path, "one")) == 2
    for _ in range(3):
        publish(table.filter("a < 0"))
    assert documents_of(spark, tmp_path, "one") == [] and document_store.count(str(tmp_path), "one") == 0
    # What failed or was replaced twice is gone.
    assert len([f for f in (tmp_path / "one").iterdir() if f.name.startswith("manifest")]) == 2
    assert len([f for f in (tmp_path / "one").iterdir() if f.name.startswith("data")]) <= 2


def test_documents_are_appended(spark, tmp_path):
    document_store.register(spark)
    for k in range(3):
        sinks.as_documents(spark.range(k, k + 2)).write.format("documents").mode("append").option("collection", "c").save(str(tmp_path))
    assert documents_of(spark, tmp_path, "c") == sorted(json.dumps({"id": i}, separators=(",", ":")) for i in (0, 1, 1, 2, 2, 3))
    assert document_store.count(str(tmp_path), "c") == 6
    assert document_store.count(str(tmp_path), "absent") == 0


def test_a_failed_text_publish_leaves_the_old_collection(spark, tmp_path):
    publish = lambda table: sinks.publish_documents(spark, {"one": table}, str(tmp_path)).first().documents
    assert publish(spark.range(5)) == 5
    with pytest.raises(Exception, match="no such row"):
        publish(failing(spark))
    assert spark.read.text(f"{tmp_path}/one").count() == 5
    assert publish(spark.range(0)) == 0 and spark.read.text(f"{tmp_path}/one").count() == 0
    assert [f.name for f in tmp_path.iterdir()] == ["one"]


def test_a_publish_that_was_ended_between_two_renames(spark, tmp_path):
    publish = lambda table: sinks.publish_documents(spark, {"one": table}, str(tmp_path)).first().documents
    publish(spark.range(5))
    (tmp_path / "one").rename(tmp_path / ".one-before")
    with pytest.raises(Exception, match="no such row"):
        publish(failing(spark))
    assert publish(spark.range(3)) == 3 and spark.read.text(f"{tmp_path}/one").count() == 3
    assert [f.name for f in tmp_path.iterdir()] == ["one"]


def test_a_connector_counts_what_it_wrote(spark, tmp_path):
    # Each evaluation gives other rows: counting the source again would tell another number.
    table = spark.range(1000).filter(F.rand() < 0.5)
    counts = sinks.publish_documents(spark, {"one": table}, "", format="json", path=str(tmp_path / "c"))
    assert counts.first().documents == spark.read.json(str(tmp_path / "c")).count()


@pytest.mark.parametrize("kind", ["plain", "gz", "bz2"])
def test_compressed_dumps_in_small_splits(spark, tmp_path, kind):
    import bz2
    import gzip
    import random

    rng = random.Random(6)
    pages, expected, number = [], [], 0
    for p in range(40):
        revisions = []
        for _ in range(rng.choice([1, 2, 60])):
            number += 1
            noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(2000))
            revisions.append(f"<revision><id>{number}</id><timestamp>t</timestamp><contributor><username>u</username><id>3</id></contributor><text bytes=\"{number}\">{noise}</text></revision>")
            expected.append((f"Title_{p}", number, number))
        pages.append(f"<page><title>Title {p}</title><id>{p}</id>\n{''.join(revisions)}\n</page>")
    data = ("<mediawiki>\n<siteinfo/>\n" + "\n".join(pages) + "\n</mediawiki>").encode()
    name, packed = {"plain": ("d.xml", data), "gz": ("d.xml.gz", gzip.compress(data)), "bz2": ("d.xml.bz2", bz2.compress(data, 1))}[kind]
    (tmp_path / name).write_bytes(packed)
    settings = {"spark.sql.files.maxPartitionBytes": "60k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = raw.scan_xml_dump(spark, str(tmp_path))
        rows = [(r.article_title, r.revid, r["size"]) for r in found.collect()]
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(rows) == sorted(expected)
    assert splits == 1 if kind == "gz" else splits > 10
