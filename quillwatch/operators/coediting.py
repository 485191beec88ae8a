"""Who edits the same article at about the same time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import mentions

# Fixed value: what marks a user name as a bot's, wherever it occurs.
BOT_WORDS = ("bot",)
DAY_SECONDS = 86_400
# The network is defined over the most active editors; None takes all of them.
TOP_EDITORS = 200


def named_edits(revisions: DataFrame) -> DataFrame:
    """Edits by people who were logged in and do not look like bots."""
    return revisions.filter((F.col("userid") > 0) & ~mentions("user", BOT_WORDS)).select(
        "article_title", "user", "edit_timestamp"
    )


def editor_activity(edits: DataFrame) -> DataFrame:
    return edits.groupBy("user").agg(F.count(F.lit(1)).alias("edits"))


def top_editors(edits: DataFrame, k: int = TOP_EDITORS) -> DataFrame:
    """The ``k`` most active editors; equal activity is settled by name."""
    return editor_activity(edits).orderBy(F.desc("edits"), F.asc("user")).limit(k)


def of_top_editors(edits: DataFrame, k: int | None = TOP_EDITORS) -> DataFrame:
    """Edits by the top ``k``, or by everyone. How the names are joined is left to Spark."""
    return edits if k is None else edits.join(top_editors(edits, k).select("user"), "user", "left_semi")


def edits_per_second(edits: DataFrame, window_seconds: int = DAY_SECONDS) -> DataFrame:
    """(article_title, window, user, at, n): edits counted by second ``at`` inside windows of
    ``window_seconds``."""
    second = F.unix_timestamp(F.col("edit_timestamp").cast("timestamp"))
    return (
        edits.filter(F.col("edit_timestamp").isNotNull())
        .select(
            "article_title",
            "user",
            F.coalesce(F.floor(second / window_seconds), F.lit(0)).alias("window"),
            F.pmod(second, F.lit(window_seconds)).alias("at"),
        )
        .groupBy("article_title", "window", "user", "at")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _by_prefix(seconds: DataFrame, window_seconds: int) -> DataFrame:
    """(article_title, window, level, prefix, upper, user, n): edits counted by the leading bits
    of their second, for every number ``level`` of bits left out, and by the next bit, ``upper``.

    Of two seconds, one is earlier exactly when at one level both have the same prefix, the
    earlier one with ``upper`` unset and the later one with it set. Level -1 keeps whole
    seconds, with ``upper`` null, for equal ones."""
    levels = F.array(*[F.lit(i) for i in range(-1, (window_seconds - 1).bit_length())])
    level, at = F.col("level"), F.col("at")
    shift = lambda by: F.call_function("shiftright", at, by)
    return (
        seconds.select("article_title", "window", "user", "at", "n", F.explode(levels).alias("level"))
        .select(
            "article_title", "window", "user", "n", "level",
            shift(level + 1).alias("prefix"),
            F.when(level >= 0, shift(F.greatest(level, F.lit(0))).bitwiseAND(F.lit(1)) == 1).alias("upper"),
        )
        .groupBy("article_title", "window", "level", "prefix", "upper", "user")
        .agg(F.sum("n").alias("n"))
    )


def coedit_pairs(edits: DataFrame, within_seconds: int = DAY_SECONDS) -> DataFrame:
    """How often two editors met on an article: (article, editor_a < editor_b, n_pairs), where
    ``n_pairs`` counts pairs of edits at most ``within_seconds`` apart.

    Pairs of edits are counted, never listed. Cut time into windows of ``within_seconds``.
    Two edits in the same window are always close enough, so the product of two counts
    covers them. Edits in neighbouring windows are close enough when the later one's place in
    its window is not behind the earlier one's; places are compared by their leading bits, which
    are part of the join key. A busy article and day is thus spread over many keys, and each
    holds at most two counts per editor.
    """
    seconds = edits_per_second(edits, within_seconds)
    cells = seconds.groupBy("article_title", "window", "user").agg(F.sum("n").alias("n"))
    key = ["article_title", "window"]
    side = lambda rows, keys, name: rows.select(*keys, F.col("user").alias(name), F.col("n").alias(f"n_{name}"))
    same = side(cells, key, "u").join(side(cells, key, "v"), key).filter("u < v")

    # Spark computes and deals out these counts once for both sides.
    counts = _by_prefix(seconds, within_seconds)
    key = [*key, "level", "prefix"]
    earlier = side(counts.filter("upper OR upper IS NULL"), key, "u")
    later = counts.filter("NOT upper OR upper IS NULL").withColumn("window", F.col("window") - 1)
    next_window = earlier.join(side(later, key, "v"), key).filter("u <> v")
    met = [
        rows.select(
            F.col("article_title").alias("article"),
            F.least("u", "v").alias("editor_a"),
            F.greatest("u", "v").alias("editor_b"),
            (F.col("n_u") * F.col("n_v")).alias("n"),
        )
        for rows in (same, next_window)
    ]
    return met[0].unionByName(met[1]).groupBy("article", "editor_a", "editor_b").agg(F.sum("n").alias("n_pairs"))


def coediting_edges(pairs: DataFrame) -> DataFrame:
    """Weighted edges; ``pairs`` holds an article once per pair, so counting rows counts
    distinct articles."""
    return pairs.groupBy("editor_a", "editor_b").agg(
        F.sum("n_pairs").alias("co_edit_count"), F.count(F.lit(1)).alias("shared_articles")
    )


def coedit_graph(revisions: DataFrame, k: int | None = TOP_EDITORS) -> DataFrame:
    """The network of the top ``k`` editors (None: of all)."""
    return coediting_edges(coedit_pairs(of_top_editors(named_edits(revisions), k)))
