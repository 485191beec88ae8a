"""Operators against brute force."""

import hashlib
import itertools
import math
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
import odd  # noqa: E402

from quillwatch.llm import chat, components, decontaminate, exact, kneser_ney, lines, mixing, pseudo_likelihood, simhash, substrings, text, urls  # noqa: E402
from quillwatch.llm.queries import QUERIES  # noqa: E402


# words


@given(st.lists(st.text(alphabet="aB1 \n\té-.", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_hashed_words_are_the_words(texts):
    data = [t.encode() for t in texts]
    seen = {}
    for alphabet, split in ((text.PLAIN, bytes.split), (text.FOLDED, lambda t: t.lower().split()), (text.ALPHANUMERIC, decontaminate.words_of)):
        for first, words, begins in text.hashed_words(data, alphabet):
            for i in range(len(begins) - 1):
                expected = split(data[first + i])
                own = words[begins[i] : begins[i + 1]]
                assert len(own) == len(expected)
                for number, word in zip(own.tolist(), expected):
                    key = alphabet[1].tobytes(), word
                    assert seen.setdefault(key, number) == number
    by_number = Counter((k[0], v) for k, v in seen.items())
    assert all(n == 1 for n in by_number.values())


def test_long_text_is_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(text, "_PIECE", 64)
    rng = random.Random(0)
    long = odd.sentence(rng, 300).encode() + b"x" * 500 + b" end"
    (_, pieces, begins), = text.hashed_words([long], text.PLAIN)
    monkeypatch.setattr(text, "_PIECE", 1 << 20)
    (_, whole, _), = text.hashed_words([long], text.PLAIN)
    assert pieces.tolist() == whole.tolist() and begins.tolist() == [0, len(whole)]


def test_windows_agree_where_words_agree():
    rng = random.Random(1)
    data = [odd.sentence(rng, 200, 3).encode() for _ in range(3)]
    (_, words, begins), = text.hashed_words(data, text.PLAIN)
    found = text.windows(words, 5)
    fits = text.inside(begins, len(words), 5)
    flat = [w for d in data for w in d.split()]
    names = {}
    for i in np.flatnonzero(fits):
        assert names.setdefault(tuple(flat[i : i + 5]), found[i]) == found[i]
    assert len(set(names.values())) == len(names)
    assert fits.sum() == 3 * 196


# exact dedup


@given(st.lists(st.integers(0, 8), max_size=200), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_misra_gries_holds_all_frequent_values(values, counters):
    held = exact.misra_gries((values[i : i + 7] for i in range(0, len(values), 7)), counters)
    assert len(held) <= counters
    assert {v for v, n in Counter(values).items() if n * (counters + 1) > len(values)} <= set(held)


@pytest.mark.parametrize("counters", [1, 4, 1024])
def test_copies_match_brute_force(spark, counters):
    rows = odd.odd_rows(3) + [(1000 + i, "The SAME text" if i % 2 else "the same TEXT", "en", "hot", 1) for i in range(70)]
    folded = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for doc_id, t, *_ in rows:
        groups[folded(t)].append(doc_id)
    keep = lambda ids: max((i for i in ids if i is not None), default=None)
    expected = sorted(repr((i, keep(ids), len(ids), hashlib.sha256(t.encode()).hexdigest())) for t, ids in groups.items() for i in ids)
    got = exact.mark_copies(odd.frame(spark, rows), counters=counters).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == expected
    stays = Counter(r.text_sha256 for r in got if r.kept)
    assert len(stays) == len(groups) and set(stays.values()) == {1}
    left = exact.drop_copies(odd.frame(spark, rows), counters=counters).collect()
    assert Counter(folded(r.text) for r in left) == Counter(dict.fromkeys(groups, 1))


# decontamination


@pytest.mark.parametrize("blocks", [3, 10_000])
def test_spans_match_brute_force(spark, blocks):
    rows = odd.odd_rows(4)
    rng = random.Random(4)
    items = [(i, " ".join((rng.choice(rows)[1] or "").split()[2:16])) for i in range(12)] + [(50, "w1 W2, w3"), (51, "..."), (51, None)]
    found = decontaminate.scan(odd.frame(spark, rows), spark.createDataFrame(items, "item_id INT, text STRING"), block_windows=blocks).collect()
    windows = set()
    for item, t in items:
        w = decontaminate.words_of((t or "").encode())
        k = min(10, len(w))
        windows |= {(str(item), tuple(w[i : i + k])) for i in range(len(w) - k + 1) if k}
    expected = []
    for _, t, *_ in rows:
        w = decontaminate.words_of((t or "").encode())
        hit, names = set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    names.add(item)
        expected.append(repr((len(w), sorted(hit), sorted(names))))
    got = [repr((r.n_words, sorted(x for s in r.spans for x in range(s.start, s.end)), r["items"])) for r in found]
    assert sorted(got) == sorted(expected)


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep  this. One, TWO three; and (four)."), (2, None), (3, "one two")], "doc_id INT, text STRING")
    bench = spark.createDataFrame([(1, "one two THREE"), (2, "four")], "item_id INT, text STRING")
    got = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert got == {1: "Keep  this. ; and ().", 2: None, 3: "one two"}
    assert [r.doc_id for r in decontaminate.remove_documents(docs, bench).orderBy("doc_id").collect()] == [2, 3]


# line dedup


def line_brute_force(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for doc_id, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(doc_id)
    first = lambda ids: min((i for i in ids if i is not None), default=None)
    out = []
    for doc_id, t, *_ in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(holders.get(key(x), ())) < 2 or first(holders[key(x)]) == doc_id]
        out.append(repr((doc_id, len(all_lines), len(all_lines) - len(kept), "\n".join(kept))))
    return sorted(out)


def cleaned(store, docs):
    return sorted(repr((r.doc_id, r.n_lines, r.n_dropped, r.text)) for r in lines.clean(store, docs).collect())


@pytest.mark.parametrize("hot", [2, 1_000_000])
def test_lines_inserted_and_deleted(spark, monkeypatch, tmp_path, hot):
    monkeypatch.setattr(lines, "HOT", hot)
    monkeypatch.setattr(lines, "SHARD_KEYS", 20)
    rows = odd.odd_rows(6)
    docs = odd.frame(spark, rows)
    half = [r for r in rows if r[0] is not None and r[0] % 2]
    store = lines.insert(None, docs)
    assert store.shards > 1
    assert cleaned(store, docs) == line_brute_force(rows)
    # Two insertions come to the same as one; deleting one of them leaves the other.
    rest = [r for r in rows if r not in half]
    first = lines.insert(lines.insert(lines.empty(docs), odd.frame(spark, rest)), odd.frame(spark, half))
    assert cleaned(first, docs) == line_brute_force(rows)
    lines.save(first, str(tmp_path / "store"))
    without = lines.delete(lines.load(spark, str(tmp_path / "store")), odd.frame(spark, half))
    assert cleaned(without, odd.frame(spark, rest)) == line_brute_force(rest)
    filters = lambda s: {r.shard: (np.frombuffer(r["filter"], np.uint16) > 0).sum() for r in s.filters.collect()}
    alone = lines.insert(None, odd.frame(spark, rest))
    assert sum(filters(without).values()) == sum(filters(alone).values())


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.randoms())
@settings(max_examples=40, deadline=None)
def test_cuckoo_filter(keys, rng):
    keys = np.array(sorted(keys), dtype=np.uint64)
    held = lines.CuckooFilter.of(keys)
    assert held.has(keys).all()
    gone = np.array([rng.random() < 0.5 for _ in keys], dtype=bool)
    held.remove(keys[gone])
    assert held.has(keys[~gone]).all()
    held.remove(keys[~gone])
    assert not held.table.any()


def test_full_filter_is_built_anew(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 10_000)
    docs = [(i, "\n".join(f"common line number {j}" for j in range(5)), "en", "s", 1) for i in range(2)]
    more = [(10 + i, "\n".join(f"other line number {j}" for j in range(400)), "en", "s", 1) for i in range(2)]
    store = lines.insert(lines.insert(None, odd.frame(spark, docs)), odd.frame(spark, more))
    assert cleaned(store, odd.frame(spark, docs + more)) == line_brute_force(docs + more)


def test_shards_grow_with_the_store(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 20)
    few = [(i, "\n".join(f"common line number {j}" for j in range(5)), "en", "s", 1) for i in range(2)]
    many = [(10 + i, "\n".join(f"other line number {j}" for j in range(100)), "en", "s", 1) for i in range(2)]
    store = lines.insert(None, odd.frame(spark, few))
    assert store.shards == 1
    store = lines.insert(store, odd.frame(spark, many))
    assert store.shards >= 6 and store.filters.count() > 1
    assert cleaned(store, odd.frame(spark, few + many)) == line_brute_force(few + many)
    assert cleaned(lines.delete(store, odd.frame(spark, many)), odd.frame(spark, few)) == line_brute_force(few)


# mixing


def water_fill(sizes, weights, epochs):
    """Targets by sharing out again until none is above its limit."""
    targets, clamped = {}, set()
    total = sum(sizes.values())
    while True:
        rest = total - sum(epochs * sizes[s] for s in clamped)
        weight = sum(w for s, w in weights.items() if s not in clamped)
        targets = {s: epochs * sizes[s] if s in clamped else weights[s] * rest / weight for s in sizes}
        over = {s for s in sizes if s not in clamped and targets[s] >= epochs * sizes[s]}
        if not over:
            return targets
        clamped |= over
        if len(clamped) == len(sizes):
            return {s: float(epochs * sizes[s]) for s in sizes}


@pytest.mark.parametrize("seed", range(3))
def test_targets_match_water_filling(spark, seed):
    rng = random.Random(seed)
    rows = [(f"s{i:03}" if i else None, int(10 ** rng.uniform(0, 6))) for i in range(40) for _ in range(3)] + [("ZZ", 0)]
    sizes = Counter()
    for s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    expected = water_fill(sizes, weights, 3)
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source STRING, size BIGINT").repartition(5)).collect()}
    assert {s: r.source_size for s, r in got.items()} == sizes
    for s, r in got.items():
        assert r.target == pytest.approx(expected[s])
    assert sum(r.target for r in got.values()) == pytest.approx(sum(sizes.values()))


def test_mixture_meets_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, odd.sentence(rng, rng.randrange(0, 60)), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(900)]
    docs = odd.frame(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.size == len(r.text.split()) and 0 <= r.repeats <= 3
    taken = Counter()
    for r in got:
        taken[r.source, r.target] += r.size * r.repeats
    assert all(abs(n - target) <= 60 for (_, target), n in taken.items())
    again = {r.doc_id: r.repeats for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.repeats for r in got}
    other = {r.doc_id: r.repeats for r in mixing.mix(docs, seed=1).collect()}
    assert other != again
    assert mixing.sample(docs).count() == sum(again.values())


def test_mixing_stays_in_the_jvm(spark):
    plan = mixing.mix(odd.frame(spark, odd.documents(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# chat


CHATTY = st.text(alphabet=st.sampled_from(list("[]<>/|\\sINSTSYroletext\n ")), max_size=30) | st.sampled_from(list(chat.CONTROLS)).map(lambda c: c + "\\" + c[0] + "\\" + c[1:])


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]) | CHATTY, CHATTY), max_size=5))
@settings(max_examples=300, deadline=None)
def test_what_is_rendered_reads_back(turns):
    formatted = "".join(chat.render(r, t) for r, t in turns)
    assert [t[:2] for t in chat.parse(formatted)] == turns
    for _, t, start, end in chat.parse(formatted):
        assert chat.unescape(formatted[start:end]) == t


def test_plain_text_is_not_escaped():
    assert chat.render("user", "Hello [there] <b>") == "[INST]\nHello [there] <b>\n[/INST]\n"
    assert chat.render("assistant", "</s>") == "<s>\n<\\/s>\n</s>\n"


@pytest.mark.parametrize("broken", ["x", "[INST]\n", "[INST]\na</s>\n[/INST]\n", "<|role|>\na", "<s>\na\n</s>"])
def test_other_text_is_not_read(broken):
    with pytest.raises(chat.NotReadable):
        chat.parse(broken)


def test_whole_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes </s>"), (2, 0, "system", "é"), (None, 0, "assistant", "z")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id BIGINT, turn INT, role STRING, text STRING").repartition(3)).collect()}
    assert [t[:2] for t in chat.parse(got[1].formatted)] == [("user", "hi"), ("assistant", "yes </s>")]
    assert [chat.unescape(got[1].formatted[s.start : s.end]) for s in got[1].loss_spans] == ["yes </s>"]
    assert got[2].loss_spans == [] and set(got) == {1, 2, None}


# SimHash


def test_fingerprint_by_the_book():
    rng = random.Random(5)
    for t in ("", "one", "One two THREE", odd.sentence(rng, 600), "a " * 3000):
        w = t.lower().encode().split()
        shingles = [b" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
        bits = [sum(xxhash.xxh64_intdigest(s, 42) >> i & 1 for s in shingles) for i in range(64)]
        fp = sum(1 << i for i in range(64) if 2 * bits[i] > len(shingles))
        assert simhash.fingerprint(t.encode()) == (fp, 0)
        assert simhash.fingerprint(t.encode(), again=True)[0] == fp


def clusters(rng, n=30):
    """Fingerprints near each other, with chains and dense balls."""
    out = {0}
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 14)):
            out.add(x)
            for _ in range(rng.randrange(0, 7)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


def roots_by_brute_force(values, distance):
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for x in values:
            for y in values:
                if (x ^ y).bit_count() <= distance and root[x] > root[y]:
                    root[x], changed = root[y], True
    return root


@pytest.mark.parametrize("segments", [None, 2, 3, 4, 5])
@pytest.mark.parametrize("members", [4096, 3])
def test_links_connect_what_is_close(spark, monkeypatch, segments, members):
    monkeypatch.setattr(simhash, "_MEMBERS", members)
    values = clusters(random.Random(segments or 1))
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    fps = spark.createDataFrame([(signed(v), 0) for v in values], "fp BIGINT, fp2 BIGINT").repartition(4)
    links = simhash.link_fingerprints(fps, 4, simhash.cut(segments, 4) if segments else None)
    for r in links.collect():
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4
    found = {r.node: r.root for r in components.components(links).collect()}
    expected = roots_by_brute_force(values, 4)
    groups = defaultdict(set)
    for v in values:
        groups[expected[v]].add(signed(v))
    for group in groups.values():
        assert {found.get(v, v) for v in group} == {min(group)}


def test_every_cut_covers_the_distance():
    for distance in range(10):
        for m in range(1, distance + 2):
            parts = simhash.cut(m, distance)
            assert sum(r + 1 for _, _, r in parts) == distance + 1
            assert all(len(simhash.masks(b, r)) == simhash.ball_size(b, r) for _, b, r in parts[:1] if b < 20)
    assert len(simhash.plan(10**3, 4)) >= len(simhash.plan(10**10, 4))


def test_simhash_query_matches_brute_force(spark, tmp_path):
    rows = odd.documents(9, 120)
    odd.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_simhash"](spark, str(tmp_path)).collect()}
    prints = {i: simhash.fingerprint((t or "").encode())[0] for i, t, *_ in rows}
    root = roots_by_brute_force(sorted(set(prints.values())), 4)
    smallest = {}
    for i, fp in sorted(prints.items()):
        smallest.setdefault(root[fp], i)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{fp:016x}", smallest[root[fp]]) for i, fp in prints.items()}


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(12)
    base = [odd.sentence(rng, 300, 5000) for _ in range(12)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(base)]
    for i in range(40):
        words = base[i % 4].split()
        words[rng.randrange(300)] = "other"
        rows.append((100 + i, " ".join(words), "en", "s", 0))
    rows += [(1, base[1], "en", "s", 0), (None, base[2], "en", "s", 0)]
    got = sorted((r.doc_id for r in simhash.drop_near_copies(odd.frame(spark, rows)).collect()), key=lambda x: (x is not None, x))
    assert got == [None, 0, 1, 1, 3, *range(4, 12)]


def near_copies_by_brute_force(rows, distance=14, most=28):
    """Ids that stay when every pair of texts within the bounds is compared."""
    sets = {i: simhash.shingle_set((t or "").encode(), 5) for i, t, *_ in rows}
    prints = {i: simhash.majority([x, text.mix(x)]) for i, x in sets.items()}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        apart = [(x ^ y).bit_count() for x, y in zip(prints[a], prints[b])]
        if root[a] != root[b] and apart[0] <= distance and sum(apart) <= most and simhash.similarity(sets[a], sets[b]) >= 0.8:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return sorted(i for i, r in root.items() if i == r)


@pytest.mark.parametrize("entry", [16_384, 9])
def test_every_close_pair_is_compared(spark, monkeypatch, entry):
    """Documents of one template: all are close to all others, and few of those are near copies."""
    monkeypatch.setattr(simhash, "_ENTRY", entry)
    rng = random.Random(5)
    rows = []
    for t in range(4):
        template = odd.sentence(rng, 400, 10**6)
        own = [odd.sentence(rng, n, 10**6) for n in (60, 65, 70, 75, 80, 70, 75, 65)]
        rows += [(100 * t + i, f"{template} {x}", "en", "s", 0) for i, x in enumerate(own)]
        # The second half of the own words is another; no text before links these two.
        rows += [(100 * t + 50 + i, f"{template} {x[: len(x) * 9 // 10]} y{i} z{i}", "en", "s", 0) for i, x in enumerate(own[3:6])]
    got = sorted(r.doc_id for r in simhash.drop_near_copies(odd.frame(spark, rows)).collect())
    assert got == near_copies_by_brute_force(rows) and 4 < len(got) < 40


def test_near_copies_among_repeated_passages(spark):
    """One passage makes up most of all texts, whose sets of shingles differ otherwise."""
    rng = random.Random(9)
    tails = [odd.sentence(rng, 120, 10**6) for _ in range(4)]
    rows = [(i, "for " * (300 + i) + tails[i % 4], "en", "s", 0) for i in range(12)]
    rows += [(20 + i, "for " * (9 + i), "en", "s", 0) for i in range(3)]
    got = sorted(r.doc_id for r in simhash.drop_near_copies(odd.frame(spark, rows)).collect())
    assert got == near_copies_by_brute_force(rows) == [0, 1, 2, 3, 20]


def test_proposals_do_not_depend_on_the_rest_of_the_table(spark):
    """All pairs at the bound meet, once each: 14 of 64 bits, 28 of 128."""
    rng = random.Random(3)
    pairs = []
    for i in range(300):
        fp, fp2 = rng.getrandbits(64), rng.getrandbits(64)
        n = rng.choice([0, 5, 10, 13, 14, 14, 15])
        m = 28 - n + rng.choice([0, 0, 1, -3])
        flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
        pairs.append((n <= 14 and n + m <= 28, (2 * i, fp, fp2), (2 * i + 1, flip(fp, n), flip(fp2, m))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, signed(a), signed(b), 10, i) for _, *two in pairs for i, a, b in two]
    elements = spark.createDataFrame(rows, "node long, fp long, fp2 long, size long, label long")
    want = sorted((x[0], y[0]) for close, x, y in pairs if close)
    assert sorted(tuple(r) for r in simhash.open_pairs(elements, 14, 28, 0.8).collect()) == want
    forest = simhash.loose_forest(elements.select("node", "fp", "fp2"), 14, 28).collect()
    assert {tuple(sorted(r)) for r in forest} == set(want)


@pytest.mark.parametrize("seed", range(3))
def test_components_match_brute_force(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(300, i) for i in range(301, 340)]
    rng.shuffle(links)
    root = {n: n for pair in links for n in pair}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a BIGINT, b BIGINT").repartition(3)).collect()}
    single = {a for a, b in links if a == b}
    assert {n: got.get(n, n) for n in root} == root and set(root) - set(got) <= single


# substring dedup


def test_difference_covers():
    for period in range(1, 25):
        cover = substrings.difference_cover(period)
        assert all(any((i + d) % period in cover and (j + d) % period in cover for d in range(period)) for i in range(period) for j in range(period))
    assert substrings.difference_cover(13) == (0, 1, 3, 9)


@pytest.mark.parametrize("window", [3, 7, 20])
@pytest.mark.parametrize("piece", [1 << 20, 200])
def test_repeats_match_brute_force(spark, monkeypatch, window, piece):
    rows = [r for r in odd.documents(window, 50)] + [(None, "w1 " * 90, None, None, 0), (None, "w1 " * 90, None, None, 0)]
    rows += [rows[0], rows[7]]
    seen, gone = {}, defaultdict(set)
    unique = sorted({(i is not None, i or 0, t or "") for i, t, *_ in rows})
    for _, i, t in unique:
        words = t.split()
        for at in range(len(words) - window + 1):
            if tuple(words[at : at + window]) in seen:
                gone[i, t] |= set(range(at, at + window))
            seen.setdefault(tuple(words[at : at + window]), (i, at))
    expected = sorted(repr((i, len((t or "").split()), " ".join(w for k, w in enumerate((t or "").split()) if k not in gone[i or 0, t or ""]))) for i, t, *_ in rows)
    docs = odd.frame(spark, rows)
    got = substrings.remove_repeats(docs, window).collect()
    assert sorted(repr((r.doc_id, r.n_words, r.text)) for r in got) == expected
    assert all(r.n_removed == r.n_words - len(r.text.split()) for r in got)


def test_rows_of_one_id_with_different_texts(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(f"x{rng.randrange(10**6)}" for _ in range(n))
    shared, alone = words(25), [words(33) for _ in range(3)]
    rows = [(1, alone[0]), (1, f"{shared} {alone[1]}"), (2, f"{alone[2]} {shared}"), (2, f"{alone[2]} {shared}"), (3, None), (3, "")]
    for seed in range(4):
        docs = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "doc_id BIGINT, text STRING").repartition(4)
        got = sorted((r.doc_id, r.n_removed, r.text) for r in substrings.remove_repeats(docs, 20).collect())
        assert got == sorted([(1, 0, alone[0]), (1, 0, f"{shared} {alone[1]}"), (2, 25, alone[2]), (2, 25, alone[2]), (3, 0, ""), (3, 0, "")])


def test_each_text_is_hashed_in_one_pass_for_anchors_and_one_for_windows(spark, tmp_path):
    spark.createDataFrame([(i, "a b c d " * 9) for i in range(40)], "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/d")
    cleaned = substrings.remove_repeats(spark.read.parquet(f"{tmp_path}/d"))
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") <= 5 + plan.count("ReusedExchange")


# URL filters


def test_rules_match_brute_force(spark):
    rng = random.Random(1)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com", "ax.com"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/é"]
    rules = {(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(12)}
    pages = [(i, f"http://{rng.choice(['', 'W.', 'w.v.'])}{rng.choice(hosts).title()}{rng.choice(paths)}{rng.choice(['', 'c', '?/a', '#x'])}") for i in range(200)]
    rows = [(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block"), ("", "/", "block")]
    got = urls.judge(spark.createDataFrame(pages, "page_id INT, url STRING"), spark.createDataFrame(rows, "host STRING, path STRING, verdict STRING"), default="unknown")
    for r in got.collect():
        rest = r.url.split("://")[1].replace("#", "?").split("?")[0]
        host, path = (rest.split("/", 1) + [None])[:2]
        host, path = host.lower(), "" if path is None else "/" + path
        fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "unknown"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *best[2:])


def test_line_dedup_works_without_pandas_in_the_workers(spark):
    """Each worker would hold its own copy of it."""
    assert not {"pd", "pandas"} & set(vars(lines))
    docs = odd.frame(spark, odd.documents(2))
    plan = lines.clean(lines.insert(None, docs), docs)._jdf.queryExecution().toString()
    assert "InArrow" in plan and "InPandas" not in plan


# Kneser-Ney


def kneser_ney_by_hand(texts):
    """Interpolated modified Kneser-Ney over token tuples, with dictionaries."""
    start = "\0"
    raw = Counter()
    for t in texts:
        padded = [start, start, *t]
        for i in range(2, len(padded)):
            raw[tuple(padded[i - 2 : i + 1])] += 1
    counts = {3: raw, 2: Counter(g[1:] for g in raw)}
    counts[1] = Counter(g[1:] for g in counts[2])
    stats = {}
    for order, table in counts.items():
        n = [sum(1 for c in table.values() if c == k) for k in (1, 2, 3, 4)]
        d = kneser_ney.discounts(n)
        total, back = Counter(), Counter()
        for g, c in table.items():
            total[g[:-1]] += c
            back[g[:-1]] += d[min(c, 3) - 1]
        stats[order] = d, total, back

    def p(gram):
        order = len(gram)
        if order == 0:
            return 1 / (len(counts[1]) + 1)
        d, total, back = stats[order]
        context = gram[:-1]
        if not total[context]:
            return p(gram[1:])
        c = counts[order][gram]
        own = (c - d[min(c, 3) - 1]) / total[context] if c else 0.0
        return own + back[context] / total[context] * p(gram[1:])

    def loss(t):
        padded = [start, start, *t]
        return -sum(math.log(p(tuple(padded[i - 2 : i + 1]))) for i in range(2, len(padded)))

    return loss


def test_perplexity_matches_the_formula(spark):
    rng = random.Random(3)
    rows = [(i, odd.sentence(rng, rng.randrange(0, 40), 15) + rng.choice(["", ".", " !!"]), "en", "s", 0) for i in range(80)]
    docs = odd.frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(80)], "doc_id BIGINT, quality INT, toxic INT")
    chosen = {r.doc_id for r in kneser_ney.trusted_half(labels, 0).collect()}
    assert 5 < len(chosen) and not chosen & {r.doc_id for r in kneser_ney.trusted_half(labels, 1).collect()}
    tokens = {i: kneser_ney._TOKEN.findall(t) for i, t, *_ in rows}
    loss = kneser_ney_by_hand([tokens[i] for i in chosen])
    got = kneser_ney.with_loss(docs, kneser_ney.fit(docs, labels)).collect()
    for r in got:
        assert r.n_tokens == len(tokens[r.doc_id])
        assert r.loss == pytest.approx(loss(tokens[r.doc_id]), rel=1e-4, abs=1e-4)


def test_probabilities_add_to_one(spark):
    rng = random.Random(4)
    texts = [odd.sentence(rng, 30, 8) for _ in range(20)]
    docs = odd.frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id BIGINT, quality INT, toxic INT")
    model = kneser_ney.fit(docs, labels)
    words = sorted({w for t in texts for w in t.split()})
    known = [w for w in words if model.logp[1].get(kneser_ney.tokens_of(w.encode()), 0.0)[1][0]]
    for context in (["w1", "w2"], ["w7", "none"], ["none", "none"]):
        total = sum(math.exp(model.scores([kneser_ney.tokens_of(" ".join([*context, w]).encode())])[-1]) for w in [*known, "none"])
        assert total == pytest.approx(1.0, abs=1e-4)


def test_good_documents_stay_and_bad_ones_go(spark):
    rng = random.Random(6)
    good = [(i, odd.sentence(rng, 80, 300), ("en", "de")[i % 2], "s", 0) for i in range(200)]
    bad = [(1000 + i, " ".join(f"{c}{rng.randrange(10**6)} %%%" for c in "abcdefgh" * 5), ("en", "fr")[i % 2], "s", 0) for i in range(30)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)] + [(i, 1, 0) for i in range(1, 200, 4)] + [(1000, 0, 0)], "doc_id BIGINT, quality INT, toxic INT")
    kept = {r.doc_id for r in kneser_ney.classify(odd.frame(spark, good + bad), labels).where("kept").collect()}
    assert not {i for i in kept if i >= 1000} and len(kept) >= 196
    docs = odd.frame(spark, good + bad)
    assert {r.doc_id for r in kneser_ney.keep_good(docs, labels).collect()} == kept


def test_bounds_of_the_fit(spark):
    docs = odd.frame(spark, [(i, f"a{i} b{i} c{i}", "en", "s", 0) for i in range(60)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id BIGINT, quality INT, toxic INT")
    assert len(kneser_ney.fit(docs, labels, max_docs=5).logp[1].keys) == 15
    assert len(kneser_ney.fit(docs, labels, max_tokens=7).logp[1].keys) == 7


def test_all_trusted_documents_are_counted(spark, monkeypatch):
    """More documents and tokens than the bounds that the fit had, in many blocks, against dictionaries."""
    monkeypatch.setattr(kneser_ney, "_BLOCK", 5000)
    rng = random.Random(5)
    rows = [(i, odd.sentence(rng, 8, 900) + f" only{i}", "en", "s", 0) for i in range(4600)]
    rows += [(5000, "none of these", None, "s", 0), (5001, None, "de", "s", 0), (None, rows[0][1], "en", "s", 0), (5002, odd.sentence(rng, 3000, 900), "en", "s", 0)]
    docs = odd.frame(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4600)], "doc_id BIGINT, quality INT, toxic INT")
    chosen = {r.doc_id for r in kneser_ney.trusted_half(labels, 0).collect()}
    assert len(chosen) > 2000
    tokens = {i: kneser_ney._TOKEN.findall(t or "") for i, t, *_ in rows}
    loss = kneser_ney_by_hand([tokens[i] for i in chosen])
    got = kneser_ney.classify(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == len(tokens[r.doc_id])
        assert r.loss == pytest.approx(loss(tokens[r.doc_id]), rel=1e-4, abs=1e-4)


def test_ngrams_travel_packed(spark, monkeypatch):
    """Triples come back from the rows of the shards, each in one shard, in a fraction of the 40 bytes a token that they took as numbers."""
    monkeypatch.setattr(kneser_ney, "_BLOCK", 3000)
    rng = random.Random(8)
    texts = [odd.sentence(rng, 400, 300) for _ in range(60)] + ["", "one", odd.sentence(rng, 7000, 50)]
    tokens = [kneser_ney.tokens_of(t.encode()).tolist() for t in texts]
    expected = Counter(tuple(p[i : i + 3]) for t in tokens for p in [[1, 1, *t]] for i in range(len(t)))
    most = Counter(x for t in tokens for x in t).most_common(40)
    hot = np.sort(np.array([t for t, _ in most[:3]], dtype=np.uint64))
    shards = kneser_ney.Shards(7, hot, np.array([3, 1, 2]), np.sort(np.array([t for t, _ in most], dtype=np.uint64)))
    rows = kneser_ney.counted(spark.createDataFrame([(t,) for t in texts], "text string"), shards).toArrow()
    got, place = Counter(), {}
    for shard in range(7):
        for *gram, n in zip(*(x.tolist() for x in kneser_ney.merged(rows.filter(pc.equal(rows.column("shard"), shard)), shards.common))):
            assert tuple(gram) not in got
            got[tuple(gram)] += n
            place.setdefault(gram[1], set()).add(shard)
    assert got == expected
    assert all(len(s) == 1 for t, s in place.items() if t not in hot.tolist()) and max(len(place[int(t)]) for t in hot) > 1
    size = sum(len(v or b"") for r in rows.to_pylist() for v in r.values() if isinstance(v, bytes))
    assert size < 12 * sum(map(len, tokens))


def test_long_texts_frequent_tokens_and_copies(spark, monkeypatch):
    """A text longer than a block, a token that is most of the corpus, copies, tokens met only at the end of texts, against dictionaries."""
    monkeypatch.setattr(kneser_ney, "_BLOCK", 700)
    rng = random.Random(9)
    rows = [(i, " ".join("the" if rng.random() < 0.6 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(30))) + f" end{i % 9}", "en", "s", 0) for i in range(150)]
    rows += [(200, odd.sentence(rng, 2500, 90) + " the", "en", "s", 0), (201, "the " * 3000, "en", "s", 0), *[(300 + i, rows[0][1], "en", "s", 0) for i in range(40)]]
    docs, labels = odd.frame(spark, rows), spark.createDataFrame([(i, 1, 0) for i in range(202)], "doc_id BIGINT, quality INT, toxic INT")
    chosen = {r.doc_id for r in kneser_ney.trusted_half(labels, 0).collect()}
    tokens = {i: kneser_ney._TOKEN.findall(t) for i, t, *_ in rows}
    loss = kneser_ney_by_hand([tokens[i] for i in sorted(chosen & tokens.keys())])
    got = kneser_ney.classify(docs, labels).collect()
    assert len(got) == len(rows) and len({r.loss for r in got if r.doc_id >= 300}) == 1
    for r in got:
        assert r.n_tokens == len(tokens[r.doc_id])
        assert r.loss == pytest.approx(loss(tokens[r.doc_id]), rel=1e-4, abs=1e-4)


# pseudo-likelihood


def test_scores_match_brute_force(spark):
    rows = odd.documents(8)
    docs = odd.frame(spark, rows)
    vocabulary, parameters = pseudo_likelihood.train(docs, rounds=1)
    net = pseudo_likelihood.unpack(parameters.value)
    for r in pseudo_likelihood.score(docs, vocabulary, parameters).collect():
        groups = list(text.hashed_words([(r.text or "").encode()], text.FOLDED))
        numbers = vocabulary.value.numbers_of(groups[0][1]).tolist()
        edge, total = pseudo_likelihood._EDGE, 0.0
        padded = [edge, edge, *numbers, edge, edge]
        for i, n in enumerate(numbers):
            around = padded[i : i + 2] + padded[i + 3 : i + 5]
            hidden = np.tanh(net["embedding"][around].ravel() @ net["inner"] + net["inner_bias"])
            logits = (hidden @ net["outer"] + net["outer_bias"]).astype(float)
            total += logits[n] - np.log(np.exp(logits).sum())
        assert r.n_tokens == len(numbers) == len((r.text or "").split())
        assert r.log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-3)


@pytest.mark.parametrize("familiar", [0, 100, 1 << 18])
def test_every_word_has_a_probability_of_its_own(spark, monkeypatch, familiar):
    """More words than numbers: the number's probability times the word's share of it, for joined and broadcast counts."""
    monkeypatch.setattr(pseudo_likelihood, "FAMILIAR", familiar)
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 3000}" for _ in range(120)), "en", "s", 0) for i in range(60)]
    rows += [(60, None, "en", "s", 0), (None, "w1 unique", "en", "s", 0), (0, *rows[0][1:])]
    counts = Counter(w for _, t, *_ in rows for w in (t or "").split())
    assert len(counts) > 3 * pseudo_likelihood.FREQUENT
    docs = odd.frame(spark, rows)
    words, parameters = pseudo_likelihood.train(docs, rounds=1)
    net = pseudo_likelihood.unpack(parameters.value)
    number = {w: numbers_of(words.value, w)[0] for w in counts}
    totals = Counter()
    for w, n in counts.items():
        totals[number[w]] += n
    got = pseudo_likelihood.score(docs, words, parameters).collect()
    assert len(got) == len(rows)
    for r in got:
        own = (r.text or "").split()
        numbers = np.array([number[w] for w in own], dtype=np.int32)
        around = pseudo_likelihood.neighbours(numbers, np.array([0, len(own)]))
        total = float(pseudo_likelihood.log_probabilities(net, around, numbers).sum()) if own else 0.0
        total += sum(math.log(counts[w] / totals[number[w]]) for w in own)
        assert r.log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-3)
    new = odd.frame(spark, [(1, "never seen", "en", "s", 0)])
    r = pseudo_likelihood.score(new, words, parameters).first()
    assert r.n_tokens == 2 and r.log_likelihood < -2 * math.log(2)


def test_training_learns_from_both_sides(spark):
    rng = random.Random(7)
    # The middle word is given by the two around it.
    def line():
        a, b = rng.randrange(6), rng.randrange(6)
        return f"l{a} m{(a + b) % 6} r{b}"
    rows = [(i, " ".join(line() for _ in range(120)), "en", "s", 0) for i in range(400)]
    docs, held_out = odd.frame(spark, rows[:360]).coalesce(1), odd.frame(spark, rows[360:])
    def mean(rounds):
        r = pseudo_likelihood.score(held_out, *pseudo_likelihood.train(docs, rounds=rounds)).agg({"log_likelihood": "sum", "n_tokens": "sum"}).first()
        return r["sum(log_likelihood)"] / r["sum(n_tokens)"]
    before, after = mean(0), mean(4)
    assert before == pytest.approx(-math.log(18), abs=0.2) and after > before + 0.6


def test_every_position_is_a_target_once(spark, monkeypatch):
    """The weights of the rounds add up to all tokens of the corpus."""
    rows = odd.documents(5)
    weights = []
    real = pseudo_likelihood.train_round

    def counted(numbers, parameters, number, rounds, column):
        def run(batches):
            for batch in batches:
                n = 0
                for own, begins in pseudo_likelihood._number_rows(batch, column):
                    n += int((pseudo_likelihood.round_of(own, begins, rounds) == number).sum())
                yield pa.RecordBatch.from_pydict({"n": [n]})

        weights.append(sum(r.n for r in numbers.select(column).mapInArrow(run, "n long").collect()))
        return real(numbers, parameters, number, rounds, column)

    monkeypatch.setattr(pseudo_likelihood, "train_round", counted)
    pseudo_likelihood.train(odd.frame(spark, rows))
    assert len(weights) == pseudo_likelihood.ROUNDS and min(weights) > 0
    assert sum(weights) == sum(len((t or "").split()) for _, t, *_ in rows)


def numbers_of(vocabulary, t):
    return [int(n) for _, words, _ in text.hashed_words([(t or "").encode()], text.FOLDED) for n in vocabulary.numbers_of(words)]


def test_a_round_is_the_average_of_plain_training(spark, tmp_path):
    """Each file is a task; its texts are trained on in batches, one position at a time, without any of the array code."""
    rows = [[t for _, t, *_ in odd.documents(seed, 12)] for seed in (1, 2, 3)]
    docs = spark.createDataFrame([(t,) for part in rows for t in part], "text STRING")
    vocabulary, begin = pseudo_likelihood.vocabulary_of(docs)
    for part in rows:
        own = [(bytes(numbers_of(vocabulary.value, t)),) for t in part]
        spark.createDataFrame(own, "numbers BINARY").coalesce(1).write.mode("append").parquet(f"{tmp_path}/n")
    numbers = spark.read.parquet(f"{tmp_path}/n")
    tasks = [[bytes(r.numbers) for r in p] for p in numbers.rdd.glom().collect() if p]
    rounds, total, weights = 3, 0.0, 0
    for task in tasks:
        net = pseudo_likelihood.unpack(begin)
        squares = {n: np.full(x.shape, 0.1, dtype=np.float32) for n, x in net.items()}
        chosen = []
        for t in task:
            own = [256, 256, *t, 256, 256]
            which = pseudo_likelihood.round_of(np.array(list(t), dtype=np.int32), np.array([0, len(t)]), rounds) if t else []
            chosen += [([own[i], own[i + 1], own[i + 3], own[i + 4]], t[i]) for i in range(len(t)) if which[i] == 1]
        for at in range(0, len(chosen), pseudo_likelihood.BATCH):
            some = chosen[at : at + pseudo_likelihood.BATCH]
            steps = {n: np.zeros(x.shape) for n, x in net.items()}
            for around, target in some:
                x = net["embedding"][around].ravel()
                hidden = np.tanh(x @ net["inner"] + net["inner_bias"])
                p = np.exp(hidden @ net["outer"] + net["outer_bias"])
                error = p / p.sum() - np.eye(len(p))[target]
                back = (net["outer"] @ error) * (1 - hidden**2)
                steps["outer"] += np.outer(hidden, error)
                steps["outer_bias"] += error
                steps["inner"] += np.outer(x, back)
                steps["inner_bias"] += back
                for k, word in enumerate(around):
                    steps["embedding"][word] += (net["inner"] @ back).reshape(4, -1)[k]
            for n, step in steps.items():
                squares[n] = squares[n] + (step / len(some)) ** 2
                net[n] = net[n] - pseudo_likelihood.RATE * (step / len(some)) / np.sqrt(squares[n] + 1e-6)
            net["outer"], net["outer_bias"] = net["outer"].clip(-2, 2), net["outer_bias"].clip(-20, 20)
        total, weights = total + pseudo_likelihood.pack(net) * len(chosen), weights + len(chosen)
    got = pseudo_likelihood.train_round(numbers, begin, 1, rounds)
    assert np.abs(got - begin).max() > 0.003
    assert np.allclose(got, total / weights, atol=2e-5)


def test_the_corpus_is_scored_as_by_its_own_network(spark):
    docs = odd.frame(spark, odd.odd_rows(4)).drop("lang", "source", "n_chars")
    own = pseudo_likelihood.train_and_score(docs)
    assert own.columns == ["doc_id", "n_tokens", "log_likelihood"]
    other = pseudo_likelihood.score(docs, *pseudo_likelihood.train(docs))
    rows = lambda df: sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.log_likelihood, 2)) for r in df.collect())
    assert [r[:3] for r in rows(own)] == [r[:3] for r in rows(other)]
    assert [r[3] for r in rows(own)] == pytest.approx([r[3] for r in rows(other)], rel=0.05, abs=1)


def test_training_gradient():
    rng = np.random.default_rng(0)
    counts = [5] * pseudo_likelihood.FREQUENT
    flat = pseudo_likelihood.begin(counts, 2000)
    around, targets = rng.integers(0, 257, (64, 4)), rng.integers(0, 256, 64)
    net = pseudo_likelihood.unpack(flat)
    squares = {n: np.zeros_like(x) for n, x in net.items()}
    loss = lambda n: -pseudo_likelihood.log_probabilities(n, around, targets).mean()
    first = loss(net)
    for _ in range(60):
        pseudo_likelihood.train_batch(net, squares, around, targets)
    assert loss(net) < first - 1


def test_words_are_counted_over_all_documents(spark):
    rows = odd.documents(3)
    got = {r.word & (2**64 - 1): r.n for r in pseudo_likelihood.word_counts(odd.frame(spark, rows)).collect()}
    expected = Counter()
    for _, t, *_ in rows:
        for _, words, _ in text.hashed_words([(t or "").encode()], text.FOLDED):
            expected.update(words.tolist())
    assert got == dict(expected)
