"""Histories that the revision API returns in pages.

A page names the revision that the next one begins with, so the pages of an article form a list, and
their replies may be stored in any order, twice, or not at all. Pages are put in order by list ranking: each
page points to the one before it, and in every round to the page that its target points to, so that n
pages need log2(n) rounds. A round is one join on (title, first revision). A page takes part only until its
target is the first page of its list, and targets of such pages are all different, so no article and no page gathers rows.

The history of an article is the list that begins with the oldest revision. A missing page ends it: what
came before is kept, and pages behind the gap are told apart, as are pages that lead back to themselves. Of replies
that begin with the same revision the first one fetched is taken, then the one with most revisions; the others count as doubled. Of
two pages that name the same next one, that which begins with the smaller revision leads there. Replies without a title,
without revisions, or unreadable, are no pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch import schemas
from quillwatch.session import materialize

KEPT, AFTER_GAP, LOOP = "kept", "after_gap", "loop"
_KEY = ["article_title", "first_revid"]


def read_pages(replies: DataFrame) -> DataFrame:
    """One row per reply that holds revisions, written once: article_title, pageid, first_revid, first_time, next_revid,
    n_revisions, revisions, fetched and a row number. ``replies`` may number its calls in ``fetched``."""
    fetched = F.col("fetched") if "fetched" in replies.columns else F.lit(0)
    reply = F.from_json("reply", schemas.REVISION_PAGE)
    parsed = replies.where("article_title IS NOT NULL").select("article_title", fetched.cast("long").alias("fetched"), reply.alias("r"))
    pages = parsed.select("article_title", "fetched", F.col("r.continue.rvcontinue").alias("token"), F.explode("r.query.pages").alias("page_id", "page"))
    first = F.try_element_at("page.revisions", F.lit(1))
    return materialize(
        pages.where((F.col("page_id") != "-1") & first["revid"].isNotNull()).select(
            "article_title",
            F.col("page_id").try_cast("bigint").alias("pageid"),
            first["revid"].alias("first_revid"),
            first["timestamp"].alias("first_time"),
            F.regexp_extract("token", r"(\d+)\s*$", 1).try_cast("bigint").alias("next_revid"),
            F.size("page.revisions").cast("long").alias("n_revisions"),
            F.col("page.revisions").alias("revisions"),
            "fetched",
            F.monotonically_increasing_id().alias("row"),
        ),
        "pages",
    )


def _distinct_pages(pages: DataFrame) -> DataFrame:
    """A row per (title, first revision): the reply that is taken, and how many there were."""
    better = F.struct("fetched", -F.col("n_revisions"), F.col("next_revid").isNull(), "row")
    taken = F.struct("row", "next_revid", "n_revisions", "first_time")
    found = pages.groupBy(*_KEY).agg(F.min_by(taken, better).alias("t"), F.count(F.lit(1)).alias("replies"))
    return found.select(*_KEY, "t.*", "replies")


def _ranked(pages: DataFrame) -> DataFrame:
    """pages with ``head``, the first revision of the list they are in, and ``page_no``, their place in it from 0 on.
    ``head`` is null for pages that lead back to themselves."""
    leads = pages.where("next_revid <> first_revid").groupBy("article_title", F.col("next_revid").alias("first_revid"))
    before = leads.agg(F.min("first_revid").alias("before"))
    state = pages.join(before, _KEY, "left").select(
        *_KEY,
        F.coalesce("before", "first_revid").alias("target"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("page_no"),
        F.col("before").isNull().alias("done"),
    )
    state = materialize(state, "page-links")
    # A list of n pages is done after log2(n) rounds; what is open then goes round in a circle.
    for _ in range(state.count().bit_length() + 1):
        open_pages = state.where("NOT done")
        if open_pages.isEmpty():
            break
        targets = state.select(
            "article_title", F.col("first_revid").alias("target"), F.col("target").alias("further"), F.col("page_no").alias("more"), F.col("done").alias("ends")
        )
        moved = open_pages.join(targets, ["article_title", "target"]).select(
            *_KEY, F.col("further").alias("target"), (F.col("page_no") + F.col("more")).alias("page_no"), F.col("ends").alias("done")
        )
        state = materialize(state.where("done").unionByName(moved), "page-links")
    return state.select(*_KEY, F.when(F.col("done"), F.col("target")).alias("head"), F.when(F.col("done"), F.col("page_no")).alias("page_no"))


def chained(pages: DataFrame) -> DataFrame:
    """Every distinct page with its place and ``status``: kept, after_gap or loop."""
    distinct = _distinct_pages(pages)
    placed = materialize(distinct.join(_ranked(distinct), _KEY), "placed-pages")
    heads = placed.where("page_no = 0").groupBy("article_title").agg(
        F.min_by("first_revid", F.struct("first_time", "first_revid")).alias("oldest")
    )
    status = F.when(F.col("head").isNull(), LOOP).when(F.col("head") == F.col("oldest"), KEPT).otherwise(AFTER_GAP)
    return placed.join(heads, "article_title", "left").withColumn("status", status).drop("oldest")


def flatten_paged_revisions(replies: DataFrame) -> DataFrame:
    """The revisions of each article's kept pages, as records of the raw feed with ``page_no``."""
    pages = read_pages(replies)
    kept = chained(pages).where(F.col("status") == KEPT).select("row", "page_no")
    revisions = pages.join(kept, "row").select("article_title", "pageid", "page_no", F.explode("revisions").alias("r"))
    return revisions.select("r.*", "article_title", "pageid", "page_no")


def paging_report(chain: DataFrame) -> DataFrame:
    """Per article: pages and revisions kept, replies that were doubled, pages after a gap and in a circle, and the revision
    that the first missing page begins with, if one is missing."""
    is_kept = F.col("status") == KEPT
    last = F.max_by(F.when(is_kept, F.struct("next_revid")), F.when(is_kept, F.col("page_no")))
    found = chain.groupBy("article_title").agg(
        F.count_if(is_kept).alias("pages"),
        F.coalesce(F.sum(F.when(is_kept, F.col("n_revisions"))), F.lit(0)).alias("revisions"),
        F.sum(F.col("replies") - 1).alias("doubled"),
        F.count_if(F.col("status") == AFTER_GAP).alias("after_gap"),
        F.count_if(F.col("status") == LOOP).alias("looped"),
        last["next_revid"].alias("missing_revid"),
    )
    whole = F.col("missing_revid").isNull() & (F.col("after_gap") == 0) & (F.col("looped") == 0)
    return found.withColumn("complete", whole)
