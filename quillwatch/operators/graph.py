"""Degree and clustering on an undirected graph given as edges (editor_a, editor_b,
co_edit_count), each pair once.

Several operators read the edges more than once: hand them a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.operators.sequences import with_position
from quillwatch.session import materialize

PAGE = 1000


def symmetric_adjacency(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, from a single pass over the edges."""
    a, b = F.col("editor_a"), F.col("editor_b")
    ends = F.array(
        F.struct(a.alias("editor"), b.alias("neighbor")), F.struct(b.alias("editor"), a.alias("neighbor"))
    )
    return edges.select(F.explode(ends).alias("end"), F.col("co_edit_count").alias("weight")).select(
        "end.editor", "end.neighbor", "weight"
    )


def editor_degree(adjacency: DataFrame) -> DataFrame:
    """A neighbour occurs once per editor, so the row count is the number of neighbours."""
    return adjacency.groupBy("editor").agg(
        F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("total_co_edits")
    )


def neighbour_lists(adjacency: DataFrame) -> DataFrame:
    """Sorted neighbours of each editor as a list: output of this form for a graph of the top k
    editors, where a list holds at most k - 1 names. ``symmetric_adjacency`` is the same in long
    form, for graphs of any size, and what all other operators use."""
    return adjacency.groupBy("editor").agg(F.array_sort(F.collect_set("neighbor")).alias("neighbors"))


def neighbour_pages(adjacency: DataFrame, size: int = PAGE, tasks: int | None = None) -> DataFrame:
    """Sorted neighbours of each editor in pages of ``size`` names, numbered from 0 on: lists of bounded length in a graph
    of any size. Places come from ranges of the whole order, so a hub is cut like anything else."""
    placed = with_position(adjacency.select("editor", "neighbor"), "editor", "neighbor", tasks=tasks)
    page = F.floor(F.col("position") / size).alias("page")
    return placed.groupBy("editor", page).agg(F.sort_array(F.collect_list("neighbor")).alias("neighbors"))


def edge_neighbour_pages(edges: DataFrame, size: int = PAGE, tasks: int | None = None) -> DataFrame:
    """Both ends' neighbours on every edge, page by page: a row for each page that either end has, the list of the
    end that has fewer pages being empty behind its last. Takes written edges, as all operators here."""
    pages = materialize(neighbour_pages(symmetric_adjacency(edges), size, tasks), "neighbour-pages")
    count = pages.groupBy("editor").agg(F.max("page").alias("last"))
    last = lambda side: count.select(F.col("editor").alias(f"editor_{side}"), F.col("last").alias(f"last_{side}"))
    ends = edges.select("editor_a", "editor_b").join(last("a"), "editor_a").join(last("b"), "editor_b")
    both = ends.select("editor_a", "editor_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest("last_a", "last_b"))).alias("page"))
    for side in ("a", "b"):
        own = pages.select(F.col("editor").alias(f"editor_{side}"), "page", F.col("neighbors").alias(f"neighbors_{side}"))
        both = both.join(own, [f"editor_{side}", "page"], "left")
    none = F.array().cast("array<string>")
    return both.select("editor_a", "editor_b", "page", *[F.coalesce(f"neighbors_{s}", none).alias(f"neighbors_{s}") for s in ("a", "b")])


def edge_neighbours(edges: DataFrame) -> DataFrame:
    """Both ends' neighbour lists on every edge, in a graph of the top k editors. For graphs of
    any size, ``common_neighbours`` has the counts that come of intersecting them."""
    lists = neighbour_lists(symmetric_adjacency(edges))
    of = lambda side: lists.select(
        F.col("editor").alias(f"editor_{side}"), F.col("neighbors").alias(f"neighbors_{side}")
    )
    return edges.select("editor_a", "editor_b").join(of("a"), "editor_a").join(of("b"), "editor_b")


def triangles(edges: DataFrame) -> DataFrame:
    """Every triangle once, as corners (x, y, z).

    Edges point from the end with fewer neighbours to the end with more, so even a hub has at
    most sqrt(2 |E|) outgoing edges. A triangle is an edge whose two ends point to a common
    third: short lists of outgoing neighbours are intersected, and only triangles come out.
    """
    degree = editor_degree(symmetric_adjacency(edges))
    rank = lambda side: degree.select(
        F.col("editor").alias(f"editor_{side}"), F.struct("degree", "editor").alias(f"rank_{side}")
    )
    ranked = edges.select("editor_a", "editor_b").join(rank("a"), "editor_a").join(rank("b"), "editor_b")
    arcs = ranked.select(
        F.least("rank_a", "rank_b")["editor"].alias("x"), F.greatest("rank_a", "rank_b")["editor"].alias("y")
    )
    outgoing = arcs.groupBy("x").agg(F.collect_list("y").alias("from_x"))
    of_y = outgoing.select(F.col("x").alias("y"), F.col("from_x").alias("from_y"))
    return (
        arcs.join(outgoing, "x")
        .join(of_y, "y")
        .select("x", "y", F.explode(F.array_intersect("from_x", "from_y")).alias("z"))
    )


def common_neighbours(edges: DataFrame) -> DataFrame:
    """Per edge, how many editors are linked to both of its ends."""
    side = lambda p, q: F.struct(F.least(p, q).alias("editor_a"), F.greatest(p, q).alias("editor_b"))
    per_edge = (
        triangles(edges)
        .select(F.explode(F.array(side("x", "y"), side("x", "z"), side("y", "z"))).alias("e"))
        .groupBy("e.editor_a", "e.editor_b")
        .agg(F.count(F.lit(1)).alias("common_neighbors"))
    )
    return (
        edges.select("editor_a", "editor_b")
        .join(per_edge, ["editor_a", "editor_b"], "left")
        .fillna({"common_neighbors": 0})
    )


def _corner_sums(edges: DataFrame) -> DataFrame:
    return (
        triangles(edges)
        .select(F.explode(F.array("x", "y", "z")).alias("editor"))
        .groupBy("editor")
        .agg((2 * F.count(F.lit(1))).alias("triangle_sum"))
    )


def editor_triangles(edges: DataFrame) -> DataFrame:
    """Per editor, the common neighbours summed over its edges: twice its triangles."""
    present = symmetric_adjacency(edges).select("editor").distinct()
    return present.join(_corner_sums(edges), "editor", "left").fillna({"triangle_sum": 0})


def with_clustering(metrics: DataFrame) -> DataFrame:
    """Share of an editor's pairs of neighbours that are linked themselves."""
    pairs = F.col("degree") * (F.col("degree") - 1)
    return metrics.withColumn(
        "clustering_coefficient",
        F.when(F.col("degree") > 1, F.col("triangle_sum") / pairs).otherwise(F.lit(0.0)),
    )


def degree_with_triangles(edges: DataFrame) -> DataFrame:
    return (
        editor_degree(symmetric_adjacency(edges))
        .join(_corner_sums(edges), "editor", "left")
        .fillna({"triangle_sum": 0})
    )


def network_metrics(edges: DataFrame) -> DataFrame:
    return with_clustering(degree_with_triangles(edges))
