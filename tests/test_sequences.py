import random
import statistics

import pytest
from conftest import later
from pyspark.sql import functions as F

from quillwatch.operators import sequences

# Cut the order into many ranges, within the giant article and its bulk import too.
TINY = {"tasks": 40}
WHOLE = {"tasks": 1}


def history(seed, giant=150, others=40):
    """A third or more of all edits on one article, half of those at one moment."""
    rng = random.Random(seed)
    rows = []
    for i in range(giant):
        time = later(1000) if i % 2 else later(rng.randrange(0, 3000, 7))
        if i % 17 == 0:
            time = None
        rows.append(("Giant", rng.choice([i, i + 1000]), f"U{rng.randrange(9)}", time, rng.choice([None, rng.randrange(500)])))
    rows = list({r[1]: r for r in rows}.values())
    for i in range(others):
        rows.append((f"A{rng.randrange(8)}", 5000 + i, f"U{rng.randrange(9)}", later(rng.randrange(900000)), rng.randrange(500)))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    by_article = {}
    for r in rows:
        by_article.setdefault(r[0], []).append(r)
    for title, group in by_article.items():
        yield title, sorted(group, key=lambda r: (r[3] is not None, r[3] or later(0), r[1]))


def expected_previous(rows):
    out = {}
    for _, group in in_order(rows):
        for before, row in zip([None, *group], group):
            out[row[1]] = before[4] if before else None
    return out


@pytest.mark.parametrize("split", [WHOLE, TINY])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_previous_value_across_slices(revisions, split, seed):
    rows = history(seed)
    got = sequences.with_previous(revisions(rows).repartition(7), {"prev": "content_length"}, **split).collect()
    assert {r.revid: r.prev for r in got} == expected_previous(rows)
    assert len(got) == len(rows)


@pytest.mark.parametrize("split", [WHOLE, TINY])
def test_length_change(revisions, split):
    rows = history(4)
    previous = expected_previous(rows)
    got = {r.revid: r.length_change for r in sequences.length_change(revisions(rows), **split).collect()}
    assert got == {r[1]: None if r[4] is None else r[4] - (previous[r[1]] or 0) for r in rows}


@pytest.mark.parametrize("split", [WHOLE, TINY])
@pytest.mark.parametrize("n", [1, 7, 60, 1000])
def test_first_of_each(revisions, split, n):
    rows = history(5)
    got = {r.revid for r in sequences.first_of_each(revisions(rows), n, **split).collect()}
    assert got == {r[1] for _, group in in_order(rows) for r in group[:n]}


def test_ranges_of_a_crowded_minute_are_even(revisions):
    rows = [("Giant", i, "U", later(i / 20_000 * 60), 1) for i in range(20_000)]
    rows += [("Giant", 100_000 + i, "U", later(7), 1) for i in range(20_000)]
    cut = sequences.ranges(revisions(rows).repartition(8), sequences._in_time("article_title", "edit_timestamp", "revid"), 40)
    sizes = cut.groupBy(sequences._RANGE).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[1] == 40 and sizes[0] < 3_000


def test_null_keys_and_ids_keep_their_order(spark):
    rows = [("A", None, 1, 10), ("A", None, None, 5), (None, None, 1, 7), (None, None, 2, 8), ("A", None, 3, 20)]
    df = spark.createDataFrame(rows, "article_title STRING, edit_timestamp TIMESTAMP, revid BIGINT, content_length BIGINT")
    got = sequences.with_previous(df.repartition(3), {"prev": "content_length"}, tasks=5).collect()
    assert {(r.article_title, r.content_length): r.prev for r in got} == {("A", 5): None, ("A", 10): 5, ("A", 20): 10, (None, 7): None, (None, 8): 7}
    assert sequences.first_of_each(df, 1, tasks=5).count() == 2


@pytest.mark.parametrize("tasks", [1, 7, 60])
def test_running_totals(spark, tasks):
    rng = random.Random(8)
    units = sorted({0.0, 1.0, 0.5, 1e-12, -3.0, 1e9, *[i * 1e-13 for i in range(2000)], *[round(rng.random(), rng.choice([2, 9])) for _ in range(300)]})
    rows = [(u, rng.randrange(5), rng.randrange(5)) for u in units]
    df = spark.createDataFrame(rows, "u DOUBLE, a BIGINT, b BIGINT").repartition(5)
    got = {r.u: r for r in sequences.running_totals(df, "u", ["a", "b"], tasks).collect()}
    a = b = 0
    for u, x, y in rows:
        assert (got[u].below_a, got[u].below_b) == (a, b)
        a, b = a + x, b + y
    assert {(r.all_a, r.all_b) for r in got.values()} == {(a, b)}


def test_close_values_are_spread(spark):
    df = spark.range(10_000).select((F.col("id") * 1e-14).alias("u")).repartition(8)
    cut = sequences.ranges(df, [F.asc("u")], 20)
    assert cut.groupBy(sequences._RANGE).count().agg(F.max("count")).first()[0] < 2_000


@pytest.mark.parametrize("values", [[0.5], [0.1, 0.2], [0.3, 0.1, 0.2], [0.2] * 5 + [0.9] * 5, [0.1, 0.1, 0.1, 0.7]])
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v DOUBLE")
    assert sequences.median_of(df, "v").first()["median"] == pytest.approx(statistics.median(values))
