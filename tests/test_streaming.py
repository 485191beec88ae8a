import json

import pytest
from conftest import REVISIONS, later

from quillwatch.operators import cleaning, episodes
from quillwatch.sources import raw
from quillwatch.streaming import weekly

WEEK = 7 * 86_400


def rows_for(title, start_week, n, first_id, reverts=0):
    return [
        (title, first_id + i, f"u{i % 3}", 1, later(start_week * WEEK + i * 600), 1, i < reverts) for i in range(n)
    ]


@pytest.fixture
def log(spark, tmp_path):
    folder = str(tmp_path / "log")

    def append(rows):
        spark.createDataFrame(rows, REVISIONS).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return weekly.weekly_edit_stream(spark.readStream.schema(REVISIONS).parquet(folder))

    return append, stream


def test_final_weeks_match_the_batch(spark, log, tmp_path):
    append, stream = log
    rows = rows_for("A", 0, 12, 0, 5) + rows_for("B", 0, 4, 100) + rows_for("A", 1, 10, 200) + rows_for("A", 3, 1, 300)
    append(rows)
    got = weekly.run_available(stream(), str(tmp_path / "out"))
    batch = episodes.weekly_edit_stats(spark.createDataFrame(rows, REVISIONS)).filter("week_start < '2024-01-15'")
    key = lambda df: sorted(tuple(r) for r in df.select(batch.columns).collect())
    assert key(got) == key(batch) and got.count() == 3
    assert episodes.edit_wars(got).count() == 1


def test_later_runs_resume_and_late_edits_stay_out(log, tmp_path):
    append, stream = log
    out = str(tmp_path / "out")
    append(rows_for("A", 0, 5, 0) + rows_for("A", 2, 1, 50))
    assert weekly.run_available(stream(), out).count() == 1
    append(rows_for("A", 0, 3, 60) + rows_for("A", 4, 1, 90))  # week 0 is final already
    got = sorted((str(r.week_start), r.weekly_edits) for r in weekly.run_available(stream(), out).collect())
    assert got == [("2024-01-01", 5), ("2024-01-15", 1)]


def test_raw_feed_as_a_stream(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    edit = lambda i, day, comment: {"revid": i, "timestamp": f"2024-01-{day:02d}T10:00:00Z", "user": f"u{i}", "userid": 1, "comment": comment, "size": 1, "article_title": "A"}
    (folder / "a.json").write_text(json.dumps([edit(1, 2, "rv spam"), edit(2, 3, None), edit(3, 20, "")]))
    (folder / "b.json").write_text(json.dumps(edit(4, 4, "undo")) + "\nbroken\n")
    stream = weekly.weekly_edit_stream(cleaning.clean_revisions(raw.stream_revisions(spark, str(folder))))
    (row,) = weekly.run_available(stream, str(tmp_path / "out")).collect()
    assert (str(row.week_start), row.weekly_edits, row.weekly_reverts, row.weekly_editors) == ("2024-01-01", 3, 2, 3)
