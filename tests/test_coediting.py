import random
from collections import Counter

import pytest
from conftest import later

from quillwatch.operators import coediting


def brute_force(rows, within=86_400):
    pairs = Counter()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[2] < y[2]:
                if abs(int(x[3].timestamp()) - int(y[3].timestamp())) <= within:
                    pairs[x[0], x[2], y[2]] += 1
    return dict(pairs)


def counted(df):
    return {(r.article, r.editor_a, r.editor_b): r.n_pairs for r in df.collect()}


def edits(revisions, rows):
    return coediting.named_edits(revisions(rows))


@pytest.mark.parametrize("seed", range(4))
def test_pairs_match_brute_force(revisions, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(220):
        # One article holds most edits, crowded into few days and partly into one minute.
        title = "Giant" if rng.random() < 0.6 else f"A{rng.randrange(4)}"
        span = rng.choice([60, 90_000, 300_000])
        rows.append((title, i, f"U{rng.randrange(7)}", later(rng.randrange(span) + rng.random())))
    assert counted(coediting.coedit_pairs(edits(revisions, rows))) == brute_force(rows)


@pytest.mark.parametrize("within", [1, 63, 64, 65, 3600, 5000])
def test_other_windows(revisions, within):
    rng = random.Random(within)
    rows = [("A", i, f"U{rng.randrange(4)}", later(rng.randrange(20_000 if within > 1000 else 400))) for i in range(80)]
    assert counted(coediting.coedit_pairs(edits(revisions, rows), within)) == brute_force(rows, within)


@pytest.mark.parametrize("gap, met", [(0, True), (86_399, True), (86_400, True), (86_401, False), (172_800, False)])
@pytest.mark.parametrize("start", [0, 1, 43_200, 86_399])
def test_window_is_inclusive(revisions, gap, met, start):
    rows = [("A", 1, "x", later(start)), ("A", 2, "y", later(start + gap))]
    expected = {("A", "x", "y"): 1} if met else {}
    assert counted(coediting.coedit_pairs(edits(revisions, rows))) == expected
    flipped = [("A", 1, "y", later(start)), ("A", 2, "x", later(start + gap))]
    assert counted(coediting.coedit_pairs(edits(revisions, flipped))) == expected


def test_before_1970_and_without_time(revisions):
    rows = [
        ("A", 1, "x", later(0, "1969-12-31T23:00:00")),
        ("A", 2, "y", later(7200, "1969-12-31T23:00:00")),
        ("A", 3, "z", None),
    ]
    assert counted(coediting.coedit_pairs(edits(revisions, rows))) == {("A", "x", "y"): 1}


def test_only_named_humans(spark):
    rows = [("A", "x", 5), ("A", "Abbott", 6), ("A", "SineBot", 7), ("A", "1.2.3.4", 0), ("A", None, 8), ("A", "y", None)]
    df = spark.createDataFrame(rows, "article_title STRING, user STRING, userid BIGINT").selectExpr(
        "*", "timestamp'2024-01-01' AS edit_timestamp"
    )
    assert [r.user for r in coediting.named_edits(df).collect()] == ["x"]


def test_top_editors_settle_ties_by_name(revisions):
    rows = [("A", i, u, later(i)) for i, u in enumerate("ccbbaad")]
    top = coediting.top_editors(edits(revisions, rows), 2).collect()
    assert [(r.user, r.edits) for r in top] == [("a", 2), ("b", 2)]
    assert {r.user for r in coediting.of_top_editors(edits(revisions, rows), 2).collect()} == {"a", "b"}
    assert coediting.of_top_editors(edits(revisions, rows), None).count() == len(rows)


def test_edges_count_edits_and_articles(revisions):
    rows = [
        ("A", 1, "x", later(0)), ("A", 2, "x", later(5)), ("A", 3, "y", later(9)),
        ("B", 4, "y", later(0)), ("B", 5, "x", later(86_400)), ("C", 6, "x", later(0)), ("C", 7, "z", later(90_000)),
    ]
    got = coediting.coedit_graph(revisions(rows)).collect()
    assert [tuple(r) for r in got] == [("x", "y", 3, 2)]


def test_a_busy_article_and_day_is_spread(spark):
    import time

    from pyspark.sql import functions as F

    # 40 editors, an edit by each of them every 21 seconds for two days.
    edits = spark.range(40 * 8228).select(
        F.lit("Hot").alias("article_title"),
        F.format_string("U%02d", F.col("id") % 40).alias("user"),
        F.timestamp_seconds(1_700_000_000 + F.floor(F.col("id") / 40) * 21).alias("edit_timestamp"),
    )
    start = time.perf_counter()
    pairs = coediting.coedit_pairs(edits).collect()
    assert time.perf_counter() - start < 30
    within = sum(min(i + 4114, 8227) - max(i - 4114, 0) + 1 for i in range(8228))
    assert len(pairs) == 780 and {p.n_pairs for p in pairs} == {within}
    keys = coediting._by_prefix(coediting.edits_per_second(edits), 86_400).groupBy("window", "level", "prefix").count()
    assert keys.agg(F.max("count")).first()[0] <= 80
    plan = coediting.coedit_pairs(edits)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "collect_list" not in plan
