"""The trie of conversations against one built in memory, for any number of shards."""

import hashlib
import random
import zlib

import pytest

from quillwatch.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
ROWS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def paths_by_hand(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", digest, text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + ts[h:]
    return out


def trie_by_hand(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    rows = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            sum(n not in children for n in below), sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def some_conversations(seed, convs=120):
    rng = random.Random(seed)
    said = ["a", "é", "", "hello there", None, "x" * 30]
    rows = []
    for c in rng.sample(range(0, 350), convs) + [100, 200]:
        n = rng.choice([1, 1, 2, 3, 4, 7, 40])
        hot = rng.random() < 0.4
        for t in range(n):
            rows.append((c, t if rng.random() < 0.95 else None, "user" if t % 2 == 0 else rng.choice(["assistant", None]), "hot" if hot else rng.choice(said[: 2 + t])))
    return rows + [(None, 0, "user", "x"), (7, None, None, None)]


@pytest.mark.parametrize("tasks", [1, 4, 13, 40])
@pytest.mark.parametrize("most", [prefix_trie.SKELETON, 9])
def test_against_a_trie_in_memory(spark, tasks, most, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_PIECE", 3)
    monkeypatch.setattr(prefix_trie, "_BATCH", 16)
    rows = some_conversations(tasks)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", path STRING, shard INT").repartition(5)
    paths = prefix_trie.paths_of(prefix_trie.rebuilt(prefix_trie.turns_of(frame)))
    got = prefix_trie.trie(paths, most, tasks).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_hand(paths_by_hand(rows))


def test_copies_of_one_conversation_fill_several_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 3000) for t in range(8)]
    paths = prefix_trie.paths_of(prefix_trie.turns_of(spark.createDataFrame(rows, ROWS)))
    rows_of, size = prefix_trie.shard_rows(paths, tasks=10)
    assert rows_of.where("piece IS NOT NULL").select("last_shard").distinct().count() > 5
    assert size > 8
    got = {r.depth: r for r in prefix_trie.trie(paths, tasks=10).collect()}
    assert sorted(got) == list(range(9)) and all((r.n_convs, r.n_leaves) == (3000, 1) for r in got.values())
    assert got[8].ends_sha256 == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert got[0].saved_tokens == 2999 * 6 * 8 and got[8].parent_conv_id == 0


def test_the_skeleton_is_bounded(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400) for t in range(20)]
    paths = prefix_trie.paths_of(prefix_trie.turns_of(spark.createDataFrame(rows, ROWS)))
    _, size = prefix_trie.shard_rows(paths, most=45, tasks=12)
    assert size <= 46


def test_no_conversations(spark):
    nothing = spark.createDataFrame([], ROWS)
    assert prefix_trie.conversation_trie(nothing).collect() == []
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], ROWS)).collect() == []


def test_conversations_without_turns_end_at_the_root(spark):
    # None of these has a base conversation, and they have no more turns than they would share.
    convs = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6]
    got = prefix_trie.conversation_trie(spark.createDataFrame([(c, 0, "user", "x") for c in convs], ROWS)).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [
        (min(convs), 0, None, len(convs), 0, 1, 0, hashlib.sha256(",".join(map(str, convs)).encode()).hexdigest())
    ]
