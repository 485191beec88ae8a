"""Every registered query against its SQL counterpart, and the shape of its plan."""

import os

import pytest

from quillwatch.plans.oracles import ORACLES
from quillwatch.plans.queries import QUERIES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in got.dtypes} == types
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = relation.project(quoted).fetchall()
    rows = [tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


@pytest.mark.parametrize(
    "name",
    ["article_metrics", "join_features", "coediting_edges", "network_metrics", "edit_wars_topic", "roc_points",
     "topic_comparison", "time_between_revisions", "cap_revisions", "stability_label_median", "top_degree_labels"],
)
def test_plan_stays_in_the_jvm_and_joins_on_keys(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        assert unwanted not in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = QUERIES["editor_activity"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in plan
    assert "GreaterThan(user_id,0)" in plan


def test_join_sides_of_the_network_are_computed_once(spark):
    df = QUERIES["coedit_pairs"](spark, FOLDER)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
