"""Files that are new, changed or gone, and that no others are read."""

import json

from pyspark.sql import functions as F

from quillwatch.plans import jobs
from quillwatch.sources import manifest, raw

FILES = "dataset STRING, path STRING, length BIGINT, modified TIMESTAMP"


def write(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def test_changes(spark):
    frame = lambda rows: spark.createDataFrame([(d, p, n, None) for d, p, n in rows], FILES)
    before = frame([("x", "a", 1), ("x", "b", 2), ("x", "c", None), ("y", "a", 5)])
    now = frame([("x", "a", 1), ("x", "b", 3), ("x", "c", None), ("y", "d", 5)])
    got = {(r.dataset, r.path): (r.change, r.length) for r in manifest.changes(before, now).collect()}
    assert got == {
        ("x", "a"): ("same", 1), ("x", "b"): ("changed", 3), ("x", "c"): ("same", None), ("y", "a"): ("gone", 5), ("y", "d"): ("new", 5),
    }
    assert {r.change for r in manifest.changes(before.limit(0), now).collect()} == {"new"}
    assert {r.change for r in manifest.changes(before, now.limit(0)).collect()} == {"gone"}


def test_only_new_and_changed_files_are_read(spark, tmp_path, monkeypatch):
    feeds = jobs.Feeds(*(str(tmp_path / n) for n in ("revisions", "entities", "pageviews", "topics")))
    read, count = [], raw.ingest_counts
    monkeypatch.setattr(raw, "ingest_counts", lambda s, path, *rest: read.extend(path) or count(s, path, *rest))
    names = lambda: sorted({p.rsplit("/", 1)[-1].replace("\\", "") for p in read})
    rows = lambda df: sorted(tuple(r) for r in df.select("dataset", "file", "records", "keyed_records", "unreadable").collect())

    def ingest():
        read.clear()
        found = rows(jobs.ingest(spark, feeds, str(tmp_path / "out")))
        assert found == rows(_full(spark, feeds.counted(), count))
        return found

    revisions = tmp_path / "revisions"
    write(revisions, "odd {a,b} [1]?*.json", {"revid": 1}, {"revid": None})
    write(revisions, "b.json", {"revid": 2})
    write(tmp_path / "entities", "b.json", {"qid": "Q1"})
    write(tmp_path / "pageviews", "v.json", {"views": 1})
    assert len(ingest()) == 4 and names() == ["b.json", "odd {a,b} [1]?*.json", "v.json"]
    assert len(ingest()) == 4 and names() == []
    write(revisions, "b.json", {"revid": 2}, {"revid": 3})
    (tmp_path / "entities" / "b.json").unlink()
    write(tmp_path / "entities", "c.json", {"qid": "Q2"})
    found = ingest()
    assert names() == ["b.json", "c.json"] and len(found) == 4
    assert {r[1].rsplit("/", 1)[-1]: r[2] for r in found if r[0] == "revisions"}["b.json"] == 2
    write(revisions / "below", "d.json", {"revid": 9})
    (revisions / "below" / "bad.json").write_text("{broken")
    assert len(ingest()) == 6 and names() == ["bad.json", "d.json"]


def _full(spark, datasets, count):
    found = None
    for name, (path, key) in datasets.items():
        one = count(spark, path, key).withColumn("dataset", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


def test_a_failed_run_is_followed_by_the_same_files(spark, tmp_path, monkeypatch):
    write(tmp_path / "r", "a.json", {"revid": 1})
    feeds = {"r": (str(tmp_path / "r"), "revid")}
    state = str(tmp_path / "state")
    monkeypatch.setattr(manifest, "replace_folder", lambda *a: (_ for _ in ()).throw(OSError("no space")))
    try:
        manifest.feed_counts(spark, feeds, state)
    except OSError:
        pass
    monkeypatch.undo()
    assert manifest.remembered(spark, state).count() == 0 and not [f for f in tmp_path.iterdir() if f.name.startswith("state")]
    assert manifest.feed_counts(spark, feeds, state).first().records == 1
    assert manifest.remembered(spark, state).count() == 1
