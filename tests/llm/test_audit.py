"""The audit of filters against applying the filters one after the other."""

import random
from itertools import permutations

import pytest

from quillwatch.llm import audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text, smaller):
    words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ") if w]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": text in smaller,
    }


def brute_force(rows, labels):
    rows = [(i, t or "", p or "") for i, t, p in rows]
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    judged = []
    for i, t, p in rows:
        smaller = {u for j, u, _ in rows if i is not None and j is not None and j < i and u == t}
        judged.append((i, p, fails(t, smaller)))
    out = {}
    for p in {r[1] for r in judged}:
        mine = [(i, f) for i, q, f in judged if q == p]
        for order in permutations("ABCDE"):
            left, before = mine, []
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[x]]
                left = [(i, f) for i, f in left if not f[x]]
                out[p, "".join(order), step] = [
                    len(left), len(gone),
                    sum(f[x] and any(f[y] for y in before) for _, f in mine),
                    sum(f[x] and sum(f.values()) == 1 for _, f in mine),
                    sum(i is not None and i in good for i, _ in gone), sum(i is not None and i in toxic for i, _ in gone),
                ]
                before.append(x)
    shares = {}
    for (p, order, step), v in out.items():
        shares[p, order[step - 1]] = shares.get((p, order[step - 1]), 0) + v[1]
    return sorted((*key, *v, shares[key[0], key[1][key[2] - 1]]) for key, v in out.items())


def some_rows(seed, n=150):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "a" * 3, "A", "$", "é" * 10 + " É", "x\x1cy z", "w " * 300, " ".join(f"w{i}" for i in range(100)) + "\n" + "W " * 100]
    while len(texts) < n:
        kind = rng.randrange(4)
        if kind == 0:
            texts.append(rng.choice(texts))
        else:
            words = [f"w{rng.randrange(rng.choice([20, 400]))}" for _ in range(rng.randrange(150, 260))]
            if kind == 2:
                words[::7] = ["ABCDEFGH"] * len(words[::7])
            if kind == 3:
                words.append(rng.choice("#$%&*|"))
            texts.append(rng.choice([" ", "\n", "\r\x0b"]).join(words))
    rows = [(i * 2, t, rng.choice(["en", "de", "", None])) for i, t in enumerate(texts)]
    return rows + rng.sample(rows, 4) + [(None, texts[-1], "en"), (None, texts[-1], "en"), (3, texts[-2], None), (3, "other", "de")]


@pytest.mark.parametrize("per_key", [2, 10_000])
def test_against_applying_the_filters(spark, per_key, monkeypatch):
    monkeypatch.setattr(audit.copies_of_smaller, "__defaults__", (per_key,))
    rows = some_rows(1)
    labels = [(r[0], i % 2, i % 3) for i, r in enumerate(rows[::3])] + [(None, 1, 1), (3, None, None), (rows[0][0], 1, 0), (999, 1, 1)]
    extra = [(*r, "x", 1, "y") for r in rows]
    docs = spark.createDataFrame(extra, "doc_id BIGINT, text STRING, lang STRING, mask STRING, row INT, hash STRING").repartition(5)
    known = spark.createDataFrame([(*l, 0) for l in labels], "doc_id BIGINT, quality INT, toxic INT, id INT")
    got = audit.audit(docs, known)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute_force(rows, labels)


def test_many_copies_of_one_text_make_no_pairs(spark):
    rows = [(i, "same text", "en") for i in range(5000)] + [(9000, "other", "en")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    found = audit.failing_rows(docs).groupBy("mask").count().collect()
    assert {r["mask"]: r["count"] for r in found} == {1: 2, 17: 4999}


def test_equal_hashes_of_different_texts(spark):
    rows = spark.createDataFrame([(0, 1, 7), (1, 2, 7), (2, 3, 7), (3, 4, 8)], "row BIGINT, id BIGINT, hash BIGINT")
    texts = spark.createDataFrame([(1, 7, "a"), (2, 7, "b"), (3, 7, "a"), (4, 8, "a")], "id BIGINT, hash BIGINT, text STRING")
    assert [r.row for r in audit.copies_of_smaller(rows, texts).collect()] == [2]


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert audit.audit(spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING"), labels).collect() == []
    one = audit.audit(spark.createDataFrame([(1, None, None)], "doc_id BIGINT, text STRING, lang STRING"), labels)
    assert one.count() == 600 and {r.part for r in one.collect()} == {""}
