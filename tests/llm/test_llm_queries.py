"""Registered queries against their SQL, and the odd cases of every operator."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import odd  # noqa: E402

from quillwatch.llm import chat, decontaminate, exact, kneser_ney, lines, mixing, pseudo_likelihood, simhash, substrings, urls  # noqa: E402
from quillwatch.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def rows_of(df, columns):
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    return duckdb


def against_sql(duckdb, spark, name, folder):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        path = f"{folder}/{file}" + ("/*.parquet" if os.path.isdir(f"{folder}/{file}") else "")
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    relation = connection.sql(ORACLES[name])
    assert {c: TYPES[t] for c, t in got.dtypes} == dict(zip(relation.columns, map(str, relation.types)))
    expected = sorted(map(repr, relation.project(", ".join(columns)).fetchall()))
    assert rows_of(got, columns) == expected


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    against_sql(duck, spark, name, FOLDER)


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = odd.documents(5, 90)
    odd.frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    passages = [(1, rows[10][1]), (2, None), (3, ""), (4, "w1 w2"), (4, "w1 w2"), (10, " ".join((rows[20][1] or "a b").split()[:15]))]
    passages += [(20 + i, " ".join((t or "").split()[3:25])) for i, (_, t, *_) in enumerate(rows[:30])]
    spark.createDataFrame(passages, "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    turns = [(c, t, role, text) for c in (1, 2, 3) for t, (role, text) in enumerate([
        ("system", "[INST]\nno\n[/INST]"), ("user", "[\\INST] <s> [\\\\INST]"), ("assistant", None), ("tool", "<|/text|>"), (None, "</s>\n"),
        ("<|role|>\n", "<|text|>"), ("assistant", "\n</s>\n<s>\n"), ("user", "[[INST]<</s>")])]
    turns += [(1, 0, "system", "[INST]\nno\n[/INST]"), (1, None, "user", "last"), (None, 1, "user", "x"), (None, 2, "assistant", "yé")]
    spark.createDataFrame(turns, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").write.parquet(f"{folder}/conversations.parquet")
    pages = [None, "", "x", "http://Example.ORG", "https://a.example.org/es/1?q=://", "http://example.org/en/12#f", "ftp://b.org/", "://org/x",
             "http://x.com/fr/", "http://com/de/1", "http://com/fr", "http://notexample.org/es/", "a\nb://c.com/de/\nz?", "http://.org/", "http://org./", "http:///p"]
    pages = [(i, u, "<html>") for i, u in enumerate(pages * 2)] + [(None, "http://x.com/fr/", None)]
    spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING").write.parquet(f"{folder}/pages.parquet")
    labels = [(r[0], i % 4 != 0 and 1 or 0, 0) for i, r in enumerate(rows)] + [(None, 1, 0), (3, None, None)]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_odd_tables_same_as_sql(spark, duck, odd_folder, name):
    against_sql(duck, spark, name, odd_folder)


def small_benchmark(spark):
    return spark.createDataFrame([(1, "w1 w2 w3"), (None, "a")], "item_id BIGINT, text STRING")


def labels_of(spark, rows):
    return spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id BIGINT, quality INT, toxic INT")


FILTERS = {
    "exact": lambda spark, d, rows: exact.drop_copies(d),
    "decontaminate": lambda spark, d, rows: decontaminate.remove_documents(d, small_benchmark(spark)),
    "quality": lambda spark, d, rows: kneser_ney.keep_good(d, labels_of(spark, rows)),
    "simhash": lambda spark, d, rows: simhash.drop_near_copies(d),
}
ADDS = {
    "spans": lambda spark, d, rows: decontaminate.remove_spans(d, small_benchmark(spark)),
    "scan": lambda spark, d, rows: decontaminate.scan(d, small_benchmark(spark), block_windows=1),
    "lines": lambda spark, d, rows: lines.clean(lines.insert(None, d), d),
    "mixing": lambda spark, d, rows: mixing.mix(d),
    "substrings": lambda spark, d, rows: substrings.remove_repeats(d),
    "score": lambda spark, d, rows: pseudo_likelihood.score(d, *pseudo_likelihood.train(d, rounds=1)),
}


@pytest.mark.parametrize("name", [*FILTERS, *ADDS])
def test_nulls_repeats_and_clashing_columns(spark, name):
    rows = odd.odd_rows(2)
    docs = odd.frame(spark, rows, wide=True)
    got = {**FILTERS, **ADDS}[name](spark, docs, rows)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert len(set(got.columns)) == len(got.columns)
    n = len(got.collect())
    assert n == len(rows) if name in ADDS else 0 < n <= len(rows)


def test_clashing_columns_of_pages(spark):
    names = [c for c in odd.CLASHES if c != "url"]
    pages = spark.createDataFrame([(1, "http://a.org/x", *["y"] * len(names)), (2, None, *["y"] * len(names))], ["page_id", "url", *names])
    rules = spark.createDataFrame([("org", "/", "block")], "host STRING, path STRING, verdict STRING")
    got = urls.judge(pages, rules)
    assert got.columns[: len(pages.columns)] == pages.columns and len(set(got.columns)) == len(got.columns)
    assert sorted((r.page_id, r[got.columns[-1]]) for r in got.collect()) == [(1, "block"), (2, "allow")]


@pytest.mark.parametrize("name", [*FILTERS, *ADDS])
def test_empty_table(spark, name):
    assert {**FILTERS, **ADDS}[name](spark, odd.empty(spark), []).collect() == []


def test_other_empty_tables(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))).collect() == []
    rules = spark.createDataFrame([], "host STRING, path STRING, verdict STRING")
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id BIGINT, url STRING")
    assert {r.verdict for r in urls.judge(pages, rules).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), rules).collect() == []
    docs = odd.frame(spark, odd.documents(1))
    nothing = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert decontaminate.remove_documents(docs, nothing).count() == docs.count()
    no_labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert kneser_ney.keep_good(docs, no_labels).count() == docs.count()
    assert simhash.classes(odd.empty(spark)).collect() == []
    assert exact.mark_copies(odd.empty(spark)).collect() == []
