import random
from itertools import combinations

import pytest

from quillwatch.operators import charts, graph


def edge_table(spark, pairs):
    rows = [(min(p), max(p), i + 1, 1) for i, p in enumerate(sorted({tuple(sorted(p)) for p in pairs}))]
    return spark.createDataFrame(rows, "editor_a STRING, editor_b STRING, co_edit_count BIGINT, shared_articles BIGINT")


def neighbours(rows):
    near = {}
    for r in rows:
        near.setdefault(r.editor_a, set()).add(r.editor_b)
        near.setdefault(r.editor_b, set()).add(r.editor_a)
    return near


def random_graph(seed, hub=True):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(25)]
    pairs = [p for p in combinations(names, 2) if rng.random() < 0.2]
    return pairs + [(names[0], n) for n in names[1:]] if hub else pairs


@pytest.mark.parametrize("seed", range(3))
def test_triangles_and_clustering_match_brute_force(spark, seed):
    edges = edge_table(spark, random_graph(seed, hub=seed != 2))
    rows = edges.collect()
    near = neighbours(rows)
    linked = {(r.editor_a, r.editor_b) for r in rows}
    truth = {frozenset(t) for t in combinations(sorted(near), 3) if all(p in linked for p in combinations(t, 2))}

    found = [frozenset((r.x, r.y, r.z)) for r in graph.triangles(edges).collect()]
    assert len(found) == len(set(found)) and set(found) == truth

    common = {(r.editor_a, r.editor_b): r.common_neighbors for r in graph.common_neighbours(edges).collect()}
    assert common == {p: len(near[p[0]] & near[p[1]]) for p in linked}

    metrics = graph.network_metrics(edges).collect()
    for m in metrics:
        pairs = list(combinations(sorted(near[m.editor]), 2))
        closed = sum(p in linked for p in pairs)
        assert m.degree == len(near[m.editor])
        assert m.triangle_sum == 2 * closed
        assert m.clustering_coefficient == pytest.approx(closed / len(pairs) if pairs else 0.0)
    assert sum(m.degree for m in metrics) == 2 * len(rows)
    assert sum(m.triangle_sum for m in metrics) % 6 == 0
    sums = {r.editor: r.triangle_sum for r in graph.editor_triangles(edges).collect()}
    assert sums == {m.editor: m.triangle_sum for m in metrics}


def test_neighbour_lists(spark):
    edges = edge_table(spark, [("a", "b"), ("a", "c")])
    lists = {r.editor: r.neighbors for r in graph.neighbour_lists(graph.symmetric_adjacency(edges)).collect()}
    assert lists == {"a": ["b", "c"], "b": ["a"], "c": ["a"]}
    joined = {(r.editor_a, r.editor_b): (r.neighbors_a, r.neighbors_b) for r in graph.edge_neighbours(edges).collect()}
    assert joined == {("a", "b"): (["b", "c"], ["a"]), ("a", "c"): (["b", "c"], ["a"])}


def test_degree_one_has_no_clustering(spark):
    metrics = graph.network_metrics(edge_table(spark, [("a", "b")])).collect()
    assert {(m.degree, m.triangle_sum, m.clustering_coefficient) for m in metrics} == {(1, 0, 0.0)}


def test_labels_keep_ties_and_small_graphs(spark):
    star = edge_table(spark, [("hub", f"leaf{i:02d}") for i in range(12)])
    assert charts.top_degree_labels(star).count() == 13  # the tenth largest degree is 1
    labels = charts.top_degree_labels(star, labelled=1).collect()
    assert [(r.editor, r.degree) for r in labels] == [("hub", 12)]
    assert charts.top_degree_labels(edge_table(spark, [("a", "b"), ("b", "c")])).count() == 3


def test_summary_and_top_edges(spark):
    edges = edge_table(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    assert tuple(charts.graph_summary(edges).first()) == (4, 3, 3)
    assert [r.co_edit_count for r in charts.top_edges(edges, 2).collect()] == [3, 2]


@pytest.mark.parametrize("tasks", [1, 6])
def test_no_page_is_longer_than_its_size(spark, tasks):
    rng = random.Random(tasks)
    pairs = {("hub", f"e{i:03}") for i in range(400)} | {tuple(sorted(rng.sample([f"e{i:03}" for i in range(400)], 2))) for _ in range(900)}
    edges = spark.createDataFrame([(min(p), max(p), 1) for p in pairs], "editor_a STRING, editor_b STRING, co_edit_count INT")
    neighbours = {}
    for a, b in pairs:
        neighbours.setdefault(a, set()).add(b)
        neighbours.setdefault(b, set()).add(a)
    cut = lambda names: [sorted(names)[i : i + 50] for i in range(0, len(names), 50)]
    pages = graph.neighbour_pages(graph.symmetric_adjacency(edges), 50, tasks).collect()
    assert {(r.editor, r.page): r.neighbors for r in pages} == {(e, k): p for e, n in neighbours.items() for k, p in enumerate(cut(n))}
    joined = graph.edge_neighbour_pages(edges, 50, tasks).collect()
    for r in joined:
        for names, editor in ((r.neighbors_a, r.editor_a), (r.neighbors_b, r.editor_b)):
            assert names == dict(enumerate(cut(neighbours[editor]))).get(r.page, [])
    most = lambda a, b: max(len(cut(neighbours[a])), len(cut(neighbours[b])))
    assert len(joined) == sum(most(a, b) for a, b in pairs)
