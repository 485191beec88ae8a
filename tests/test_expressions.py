import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quillwatch import functions as q


def one(spark, value, ddl, expr):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "comment, expected",
    [
        ("Reverted edits by someone", True),
        ("UNDID revision 5", True),
        ("rv vandalism", True),
        ("conserv fix", True),  # the fragment also matches inside words
        ("rv", False),  # the blank belongs to the fragment
        ("restore", False),
        ("Restored to last good", True),
        ("RollBack", True),
        ("undone", True),
        ("→ UNDID revision", True),
        ("café", False),
        ("rollbac\u212a", False),  # the Kelvin sign is no letter k
        ("", False),
        (None, False),
    ],
)
def test_revert_flag(spark, comment, expected):
    assert one(spark, comment, "STRING", q.revert_flag("x")) is expected


def test_redundant_words_are_left_out():
    assert q.word_pattern(q.REVERT_WORDS) == "(?i)(revert|rv |undid|undo|rollback|restored)"


@pytest.mark.parametrize("text", ["2022-03-24T00:02:57Z", "not a time", None])
def test_event_time(spark, text):
    got = one(spark, text, "STRING", q.event_time("x"))
    assert got == (dt.datetime(2022, 3, 24, 0, 2, 57) if text and text[0] == "2" else None)


@pytest.mark.parametrize(
    "text, expected", [("2020010100", dt.date(2020, 1, 1)), ("20201301", None), ("x", None), (None, None)]
)
def test_view_date(spark, text, expected):
    assert one(spark, text, "STRING", q.view_date("x")) == expected


@pytest.mark.parametrize(
    "editors, edits, expected",
    [(1, 5, 0.0), (0, 0, 0.0), (4, 6, 2 / math.log2(6)), (3, 3, 1.0), (5, 3, 1.0), (2, 1, 1.0), (None, 3, 0.0), (2, None, 0.0)],
)
def test_editor_diversity(spark, editors, edits, expected):
    df = spark.createDataFrame([(editors, edits)], "a BIGINT, b BIGINT")
    assert df.select(q.editor_diversity("a", "b").alias("r")).first()["r"] == pytest.approx(expected)


def test_weeks_start_on_monday(spark):
    monday = dt.date(2024, 1, 1)
    for day in range(7):
        time = dt.datetime(2024, 1, 1 + day, 23, 59, 59)
        assert one(spark, time, "TIMESTAMP", q.week_start("x")) == monday
    assert one(spark, dt.datetime(2023, 12, 31), "TIMESTAMP", q.week_start("x")) == dt.date(2023, 12, 25)


def test_titles(spark):
    assert one(spark, "AC/DC\\x_y", "STRING", q.safe_title("x")) == "AC_DC_x_y"
    assert one(spark, "Hip_hop", "STRING", q.display_title("x")) == "Hip hop"
    assert one(spark, "political", "STRING", q.topic_label("x")) == "Political"


@pytest.mark.parametrize("rate, expected", [(0.15, 0.0), (0.150001, 1.0), (None, 0.0), (1.0, 1.0)])
def test_stability_label(spark, rate, expected):
    assert one(spark, rate, "DOUBLE", q.stability_label("x")) == expected


def test_per_never_divides_by_less_than_one(spark):
    df = spark.createDataFrame([(3, 0)], "a BIGINT, b BIGINT")
    assert df.select(q.per("a", "b")).first()[0] == 3.0


def test_search_agrees_with_the_plain_pattern(spark):
    pattern = "(?i)(" + "|".join(q.REVERT_WORDS) + ")"
    texts = ["", "x", "RV x", "rv", "RVx", "ſerv x", "UNDO ü", "Rest\u00f6red", "RESTORED", "un do", "\u0130undid", "ROLLBAC\u212a", None]
    df = spark.createDataFrame([(t,) for t in texts], "x STRING")
    rows = df.select(q.mentions("x", q.REVERT_WORDS).alias("a"), F.col("x").rlike(pattern).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and {r.a for r in rows} == {True, False, None}
