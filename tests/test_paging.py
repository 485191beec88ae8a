"""Paged histories against walking their lists one page at a time."""

import json
import random

import pytest

from quillwatch.plans import jobs
from quillwatch.sources import paging


def reply(revids, following=None, page_id="4"):
    revisions = [
        {"revid": i, "parentid": 0, "timestamp": f"2024-01-01T00:{i // 60:02}:{i % 60:02}Z", "user": "u", "userid": 1, "comment": "", "size": i} for i in revids
    ]
    more = {"continue": {"rvcontinue": f"20240101000000|{following}", "continue": "||"}} if following else {}
    return json.dumps({**more, "query": {"pages": {page_id: {"revisions": revisions}}}})


def frame(spark, rows):
    return spark.createDataFrame(rows, "article_title STRING, reply STRING")


def history(title, sizes, start=1):
    """Pages of these sizes, one after the other."""
    pages, at = [], start
    for k, size in enumerate(sizes):
        ids = list(range(at, at + size))
        at += size
        pages.append((title, ids, at if k + 1 < len(sizes) else None))
    return pages


def replies(pages):
    return [(title, reply(ids, following)) for title, ids, following in pages]


def found(spark, rows):
    got = paging.flatten_paged_revisions(frame(spark, rows))
    return sorted((r.article_title, r.page_no, r.revid) for r in got.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_one_to_a_hundred_pages_in_any_order(spark, seed):
    rng = random.Random(seed)
    pages, expected = [], []
    for n in (1, 2, 3, 8, 17, 64, 100):
        title = f"T{n}"
        own = history(title, [rng.randrange(1, 4) for _ in range(n)])
        gone = rng.randrange(1, n) if n > 3 else n
        for k, (_, ids, _) in enumerate(own[:gone]):
            expected += [(title, k, i) for i in ids]
        pages += own[:gone] + own[gone + 1 :] + rng.sample(own[:gone], gone // 3)
    rng.shuffle(pages)
    assert found(spark, replies(pages)) == sorted(expected)


def test_report(spark):
    whole, cut, single = history("whole", [2, 2, 2]), history("cut", [1] * 6), history("single", [3])
    rows = replies(whole + whole[:1] + cut[:2] + cut[3:] + single)
    rows += [("circle", reply([90], 91)), ("circle", reply([91], 90)), ("itself", reply([5], 5)), ("itself", reply([7], 5))]
    chain = paging.chained(paging.read_pages(frame(spark, rows)))
    got = {r.article_title: tuple(r)[1:] for r in paging.paging_report(chain).collect()}
    assert got == {
        "whole": (3, 6, 1, 0, 0, None, True),
        "cut": (2, 2, 0, 3, 0, 3, False),
        "single": (1, 3, 0, 0, 0, None, True),
        "circle": (0, 0, 0, 0, 2, None, False),
        "itself": (2, 2, 0, 0, 0, 5, False),
    }


def test_doubled_pages_and_pages_that_share_the_next(spark):
    # The longer reply of one beginning is taken; of two pages that lead to 9 the smaller does.
    rows = [("a", reply([1, 2], 3)), ("a", reply([1, 2, 3], 4)), ("a", reply([4])), ("b", reply([1, 2], 9)), ("b", reply([2], 9)), ("b", reply([9]))]
    assert found(spark, rows) == [("a", 0, 1), ("a", 0, 2), ("a", 0, 3), ("a", 1, 4), ("b", 0, 1), ("b", 0, 2), ("b", 1, 9)]


def test_what_is_no_page(spark):
    rows = [(None, reply([1])), ("a", None), ("a", "broken"), ("a", "{}"), ("a", reply([])), ("a", reply([1], page_id="-1")), ("a", '{"continue":{"rvcontinue":"x"},"query":{"pages":{"7":{}}}}')]
    assert found(spark, rows) == []
    assert found(spark, rows[:0]) == []
    odd = '{"continue":{"rvcontinue":"no number"},"query":{"pages":{"x":{"revisions":[{"revid":3}]}}}}'
    assert found(spark, [("a", odd)]) == [("a", 0, 3)]


def test_a_hot_article_gathers_in_no_task(spark):
    pages = history("hot", [1] * 3000)
    chain = paging.chained(paging.read_pages(frame(spark, replies(pages)).repartition(8)))
    assert paging.paging_report(chain).first().pages == 3000


def test_pages_of_later_calls(spark, tmp_path):
    feeds = jobs.Feeds(*(str(tmp_path / n) for n in ("revisions", "entities", "pageviews", "topics")))
    held = lambda: sorted((r.article_title, r.revid) for r in jobs.raw.scan_revisions(spark, feeds.revisions).collect())
    pages = history("A", [2, 2, 2, 2])
    add = lambda some: jobs.add_replies(spark, feeds, "revisions", frame(spark, replies(some)))
    add(pages[:1])
    assert held() == [("A", 1), ("A", 2)]
    add(pages[2:3] + history("B", [1]))  # the second page is missing
    assert held() == [("A", 1), ("A", 2), ("B", 1)]
    for _ in range(2):
        add(pages[1:2])
        assert held() == [("A", i) for i in range(1, 7)] + [("B", 1)]
    add(pages[3:])
    assert held() == [("A", i) for i in range(1, 9)] + [("B", 1)]
