"""The pipeline against a version of it in plain Python."""

import math
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import odd  # noqa: E402
from test_llm_operators import kneser_ney_by_hand, water_fill  # noqa: E402

import corpus_pipeline  # noqa: E402
from quillwatch.llm import decontaminate, kneser_ney  # noqa: E402

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def corpus(seed=1):
    rng = random.Random(seed)
    common = [odd.sentence(rng, 12, 400) for _ in range(3)]
    passage = odd.sentence(rng, 25, 400)
    rows = []
    for i in range(160):
        lines = [odd.sentence(rng, rng.randrange(8, 25), 400) for _ in range(rng.randrange(2, 8))]
        if i % 7 == 0:
            lines.insert(1, rng.choice(common))
        if i % 11 == 0:
            lines[-1] += " " + passage
        rows.append((i, "\n".join(lines), ("en", "de", None)[i % 3], "hot" if i % 2 else f"s{i % 5}", 0))
    for i in range(12):  # near copies that share no line with their originals
        words = rows[i][1].replace("\n", " ").split()
        words[rng.randrange(len(words))] = "w1"
        rows.append((200 + i, " ".join(words), "en", "s1", 0))
        rows.append((300 + i, rows[20 + i][1], "en", "s1", 0))
    rows += [(400 + i, " ".join(f"q{rng.randrange(10**7)} ##" for _ in range(40)), "en", "s2", 0) for i in range(10)]
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0)]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s, _ in rows]
    labels = [(i, 1, int(i % 20 == 0)) for i in range(0, 160)] + [(400, 0, 0), (None, 1, 0)]
    bench = [(1, passage), (2, "nowhere to be found"), (3, None)]
    return rows, labels, bench


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, labels, bench = corpus()
    odd.frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, bench


def good_ones(spark, rows, labels):
    frame = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    halves = [{r.doc_id for r in kneser_ney.trusted_half(frame, h).collect()} for h in (0, 1)]
    tokens = {i: kneser_ney._TOKEN.findall(t or "") for i, t, *_ in rows}
    loss_of = kneser_ney_by_hand([tokens[i] for i in sorted(halves[0])])
    loss = {i: loss_of(t) for i, t in tokens.items()}
    lang = {r[0]: r[2] for r in rows}
    limits = {}
    for group in {None, *lang.values()}:
        some = [i for i in halves[1] if tokens[i] and group in (None, lang[i])] or [i for i in halves[0] if tokens[i] and group in (None, lang[i])]
        if some:
            mean = sum(loss[i] for i in some) / sum(len(tokens[i]) for i in some)
            values = sorted((loss[i] + kneser_ney.PRIOR * mean) / (len(tokens[i]) + kneser_ney.PRIOR) for i in some)
            limits[group] = mean, values[math.ceil(kneser_ney.QUANTILE * len(values)) - 1] + math.log(kneser_ney.SLACK)
    out = []
    for row in rows:
        n = len(tokens[row[0]])
        mean, most = limits.get(row[2], limits[None])
        if not n or (loss[row[0]] + kneser_ney.PRIOR * mean) / (n + kneser_ney.PRIOR) <= most:
            out.append(row)
    return out


def without_lines(rows):
    key = lambda line: line.strip(" \t\n\v\f\r").lower()
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, t, lang, source, n in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        text = "\n".join(kept)
        out.append((i, text, lang, source, len(text) if len(kept) < len(lines) else n))
    return out


def without_near_copies(rows):
    def shingles(t):
        w = t.lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()

    sets = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and (len(sets[a] & sets[b]) / len(sets[a] | sets[b]) if sets[a] | sets[b] else 1.0) >= 0.8]
    for _ in range(30):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return [r for r in rows if root[r[0]] == r[0]]


def uncontaminated(rows, bench):
    windows = set()
    for _, t in bench:
        w = decontaminate.words_of((t or "").encode())
        k = min(10, len(w))
        windows |= {tuple(w[i : i + k]) for i in range(len(w) - k + 1) if k}
    def clean(t):
        w = decontaminate.words_of(t.encode())
        return not any(tuple(w[i : i + len(x)]) == x for x in windows for i in range(len(w) - len(x) + 1))
    return [r for r in rows if clean(r[1])]


def test_every_stage_by_brute_force(spark, tables):
    folder, rows, labels, bench = tables
    expected = [good_ones(spark, rows, labels)]
    expected.append(without_lines(expected[-1]))
    expected.append(without_near_copies(expected[-1]))
    expected.append(uncontaminated(expected[-1], bench))
    assert len(rows) > len(expected[0]) == len(expected[1]) > len(expected[2]) > len(expected[3]) > 100
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(map(repr, map(tuple, docs.collect()))) == sorted(map(repr, want)), name
    final = corpus_pipeline.run(spark, folder).collect()
    assert sorted(repr(tuple(r)[:5]) for r in final) == sorted(map(repr, expected[-1]))
    sizes = Counter()
    for r in final:
        assert r["size"] == len(r.text.split()) and 0 <= r.repeats <= 3
        sizes[r.source] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    for source in sizes:
        own = [r for r in final if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert all(r.target == pytest.approx(targets[source]) for r in own)
        assert abs(sum(r["size"] * r.repeats for r in own) - targets[source]) <= max(r["size"] for r in own)


def test_odd_documents_go_through_all_stages(spark, tables):
    folder, *_ = tables
    rows = odd.odd_rows(7)
    for docs in (odd.frame(spark, rows), odd.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() <= len(rows)


def test_the_rest_works_without_this_package(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('quillwatch.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'article_metrics' in names and not any(n.startswith('op') or n == 'pipeline' for n in names)\n"
        "assert set(e.oracle_sql()) <= names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env={**os.environ, "PYTHONPATH": ROOT})


def test_queries_are_registered():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
