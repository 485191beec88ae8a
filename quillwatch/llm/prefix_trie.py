"""The trie of conversation prefixes, by a skeleton of splitters and sorted shards.

Every turn (role and text) becomes a digest of 16 bytes, and a conversation the bytes of its turns'
digests, its path: conversations that begin alike have paths that begin alike. Sorted over the cluster by path and id, and
cut into ranges by sampled splitters, the members of a node stand side by side. A node that has members in two
neighbouring ranges is a prefix of the splitter between them: these nodes are the skeleton, and each range is told,
by broadcast, how far its first path is shared with the range before and which beginning of its last path with the range
after. All other nodes lie within one range and are finished by its task, which streams the sorted rows and keeps only the
nodes of the current path. For skeleton nodes a range writes partial sums, which are reduced by node and then added up
along the skeleton, whose size is known before.

A third of all conversations may be copies of one: they fill several ranges, as ids are part of the order, and their node is
in the skeleton. The ids that end at a skeleton node are written as text in pieces, and its digest streams over the
pieces in order. Ranges are merged until the skeleton has at most ``SKELETON`` turns, which bounds the broadcast; merged
ranges take longer but no more memory.

A conversation is one row of 21 bytes a turn, without its texts. Turns follow (turn, role, digest), nulls first; a null role or text
is empty. Rows without a conversation id belong to no conversation and are left out; repeated rows are repeated turns.
Other columns are not read. An empty table gives an empty trie. Two turns are the same if their 128-bit digests are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwatch.operators.sequences import ranges
from quillwatch.session import materialize

DIGEST = 16
SKELETON = 100_000
# Rebuilt conversations share the beginnings of one in so many, and up to so many turns.
FAMILY, SHARED_TURNS = 100, 5
_PIECE = 10_000  # ids of a piece of text
_BATCH = 4096


def turn_digest(role: Column, text: Column) -> Column:
    """32 hexadecimal digits that tell apart any two turns."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (digest, chars)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", role.alias("role"), turn_digest(role, text).alias("digest"), F.length(text).alias("chars")).alias("t")
    )
    in_order = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(
        F.transform(in_order, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """The first h turns of conversation c - c%100, then c's own turns after its first h; h = crc32(c) % 6."""
    head = F.slice("turns", 1, SHARED_TURNS).alias("head")
    heads = turns.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), head)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED_TURNS + 1)).cast("int")
    own = turns.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    none = F.slice("turns", 1, 0)
    path = F.concat(F.coalesce(F.slice("head", 1, F.col("h")), none), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return own.join(heads, "base", "left").select("conv_id", path.alias("turns"))


def paths_of(turns: DataFrame) -> DataFrame:
    """(conv_id, path, chars): digests side by side, and the code points of each text."""
    digests = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    return turns.select("conv_id", F.unhex(digests).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"))


def shared_depth(a: bytes, b: bytes) -> int:
    """Number of turns that both paths begin with."""
    n = min(len(a), len(b)) // DIGEST
    same = np.frombuffer(a, np.uint64, 2 * n).reshape(n, 2) == np.frombuffer(b, np.uint64, 2 * n).reshape(n, 2)
    differ = np.flatnonzero(~same.all(axis=1))
    return int(differ[0]) if len(differ) else n


class Skeleton:
    """Which beginnings of paths go on from a shard to the next. ``depths[i]`` is the number of turns that the last path of
    shard i - 1 and the first of shard i share, ``shared[i]`` these turns; both are empty for the first shard."""

    def __init__(self, shards: list[int], shared: list[bytes]):
        self.place = {shard: i for i, shard in enumerate(shards)}
        self.shared = [b"", *shared, b""]
        self.depths = [len(s) // DIGEST for s in self.shared]

    def before(self, shard: int) -> int:
        return self.depths[self.place[shard]]

    def after(self, shard: int) -> bytes:
        return self.shared[self.place[shard] + 1]

    def first_shard(self, shard: int, node: bytes) -> int:
        """Place of the shard where a node begins that ``shard`` shares with the one before; a node is the path to it."""
        at = self.place[shard]
        while at and self.shared[at].startswith(node):
            at -= 1
        return at


def skeleton_of(cut: DataFrame, most: int = SKELETON) -> tuple[Skeleton, dict[int, int]]:
    """The skeleton of a table in ranges, and the shard of each range. There is one row per range here."""
    ends = cut.groupBy("_range").agg(F.min(F.struct("path", "conv_id"))["path"].alias("first"), F.max(F.struct("path", "conv_id"))["path"].alias("last"))
    pairs = ends.select("_range", F.lag("last").over(Window.orderBy("_range")).alias("a"), F.col("first").alias("b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            shared = [y[: DIGEST * shared_depth(x, y)] if x is not None else b"" for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) // DIGEST for s in shared], pa.int64()), pa.array(shared, pa.binary())],
                names=["_range", "depth", "shared"],
            )

    found = materialize(pairs.mapInArrow(compare, "_range int, depth long, shared binary"), "splitters")
    depths = sorted(map(tuple, found.select("_range", "depth").collect()))
    kept = depths[1:]
    while sum(d for _, d in kept) > most:
        kept = kept[1::2]  # every second border stays
    borders = [r for r, _ in kept]
    shared = dict(found.where(F.col("_range").isin(borders)).select("_range", "shared").collect()) if borders else {}
    shard = {r: int(np.searchsorted(borders, r, side="right")) for r, _ in depths}
    return Skeleton(sorted(set(shard.values())), [bytes(shared[r]) for r in borders]), shard


class _Node:
    __slots__ = ("depth", "chars", "n", "least", "children", "leaves", "saved", "digest", "held", "pieces", "first")

    def __init__(self, depth: int, chars: int, first: int):
        self.depth, self.chars, self.first = depth, chars, first
        self.n = self.children = self.leaves = self.saved = self.pieces = 0
        self.least = None
        self.digest, self.held = None, []


_ROWS = pa.schema([
    ("shard", pa.int64()), ("node", pa.int64()), ("above_shard", pa.int64()), ("above", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("chars", pa.int64()),
    ("last_shard", pa.int64()), ("piece", pa.int64()), ("ends", pa.string()),
])
_ROWS_DDL = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _ROWS)


class _Shard:
    """One pass over the sorted rows of a shard. Nodes of the skeleton are numbered -depth - 1 in the shard where they
    begin, others from 0 on in the order of their beginning."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton = number, skeleton
        self.place, self.before, self.after = skeleton.place[number], skeleton.before(number), skeleton.after(number)
        self.opened, self.path, self.rows = 0, b"", []
        self.open: list[_Node] = [_Node(0, 0, -1)]

    def _shared(self, depth: int) -> bool:
        """Is the open node of this depth one of the skeleton? Its members may go on behind or before this shard."""
        return depth <= self.before and self.open[depth].first < 0 or self.after.startswith(self.path[: depth * DIGEST])

    def _key(self, depth: int) -> tuple[int, int]:
        node = self.open[depth]
        if not self._shared(depth):
            return self.place, node.first
        begins_before = depth <= self.before and node.first < 0
        path = self.path[: depth * DIGEST]
        return (self.skeleton.first_shard(self.number, path) if begins_before else self.place), -depth - 1

    def add(self, conv: int, path: bytes, chars: pa.Array) -> None:
        depth = len(path) // DIGEST
        common = shared_depth(self.path, path)
        self._close(common)
        if common < depth:
            # Only the first row's beginning can go on from the shard before.
            begins = self.opened == 0 and self.open[0].n == 0 and len(self.open) == 1
            for d, c in enumerate(chars[common:].to_pylist(), common + 1):
                goes_on = begins and d <= self.before
                self.open.append(_Node(d, c, -1 if goes_on else self.opened))
                self.opened += not goes_on
        self.path = path
        top = self.open[depth]
        top.n += 1
        top.least = conv if top.least is None else min(top.least, conv)
        top.held.append(str(conv))
        if len(top.held) >= _PIECE:
            self._spill(depth)

    def _spill(self, depth: int) -> None:
        """Hand on the ids held at an open node: to its digest, or, in the skeleton, as a row."""
        node = self.open[depth]
        if not node.held:
            return
        text = ",".join(node.held)
        if self._shared(depth):
            shard, number = self._key(depth)
            self.rows.append((shard, number, None, None, depth, None, None, None, None, None, None, self.place, node.pieces, text))
        else:
            node.digest = node.digest or hashlib.sha256()
            node.digest.update(("," if node.pieces else "").encode() + text.encode())
        node.pieces += 1
        node.held = []

    def _close(self, depth: int) -> None:
        """Finish the open nodes below ``depth``, from the deepest up."""
        while len(self.open) > depth + 1:
            d = len(self.open) - 1
            self._spill(d)
            shared, (shard, number) = self._shared(d), self._key(d)
            above_shard, above = self._key(d - 1)
            node, parent = self.open.pop(), self.open[-1]
            parent.n += node.n
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
            if shared:
                ends = None
            else:
                node.leaves += node.children == 0
                node.saved += (node.n - 1) * node.chars
                parent.children += 1
                parent.leaves += node.leaves
                parent.saved += node.saved
                ends = (node.digest or hashlib.sha256()).hexdigest()
            self.rows.append((
                shard, number, above_shard, above, d, node.least, node.n, node.children, node.leaves, node.saved, node.chars, self.place, None, ends,
            ))
            self.path = self.path[: (d - 1) * DIGEST]

    def finish(self) -> None:
        self._close(0)
        self._spill(0)
        root = self.open[0]
        self.rows.append((0, -1, None, None, 0, root.least, root.n, root.children, root.leaves, root.saved, 0, self.place, None, None))


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def shard_rows(paths: DataFrame, most: int = SKELETON, tasks: int | None = None) -> tuple[DataFrame, int]:
    """Finished nodes, partial sums of skeleton nodes, and pieces of ids that end at them; and the size of the skeleton."""
    cut = ranges(paths, [F.col("path"), F.col("conv_id")], tasks)
    skeleton, shard = skeleton_of(cut, most)
    spark = cut.sparkSession
    told = spark.sparkContext.broadcast(skeleton)
    numbers = spark.createDataFrame([*shard.items()], "_range int, shard int")  # a row per range
    dealt = cut.join(F.broadcast(numbers), "_range").select("shard", "conv_id", "path", "chars")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Shard | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                some = batch.slice(at, _BATCH)
                chars = some.column(3)
                for i, (number, conv, path) in enumerate(zip(*(some.column(k).to_pylist() for k in range(3)))):
                    if current is None or current.number != number:
                        if current:
                            current.finish()
                            yield _columns(current.rows, _ROWS)
                        current = _Shard(number, told.value)
                    current.add(conv, path, chars[i].values)
                    if len(current.rows) >= _BATCH:
                        yield _columns(current.rows, _ROWS)
                        current.rows = []
        if current:
            current.finish()
            yield _columns(current.rows, _ROWS)

    return materialize(dealt.mapInArrow(run, _ROWS_DDL), "trie"), sum(skeleton.depths) + 1


def _digests_of_pieces(pieces: DataFrame) -> DataFrame:
    """(shard, node, ends): the digest over the pieces of each skeleton node, in order, one piece in memory at a time."""
    schema = pa.schema([("shard", pa.int64()), ("node", pa.int64()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            for shard, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (shard, node) != key:
                    if key:
                        yield _columns([(*key, digest.hexdigest())], schema)
                    key, digest = (shard, node), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.encode())
        if key:
            yield _columns([(*key, digest.hexdigest())], schema)

    dealt = pieces.repartition("shard", "node").sortWithinPartitions("shard", "node", "last_shard", "piece")
    return dealt.select("shard", "node", "ends").mapInArrow(run, "shard long, node long, ends string")


_NODES = pa.schema([f for f in _ROWS if f.name not in ("last_shard", "piece")] + [("above_conv", pa.int64())])
_NODES_DDL = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _NODES)


def reduced_skeleton(rows: DataFrame) -> DataFrame:
    """Skeleton nodes with sums over all shards. Their table, of at most ``SKELETON`` rows, goes through one task in the
    order of the trie, which adds each node to the one above."""
    partial = rows.where("node < 0 AND piece IS NULL")
    # A node shared with the shard before is told by every shard; what stands above it is the same everywhere.
    summed = partial.groupBy("shard", "node").agg(
        *[F.max(c).alias(c) for c in ("above_shard", "above", "depth", "chars")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    ends = _digests_of_pieces(rows.where("node < 0 AND piece IS NOT NULL"))
    whole = summed.join(ends, ["shard", "node"], "left").select(
        "shard", "node", "above_shard", "above", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars",
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends"),
    )
    field = {f.name: i for i, f in enumerate(_NODES)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = [list(r) + [None] for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
        place = {(n[0], n[1]): i for i, n in enumerate(nodes)}
        for n in reversed(nodes):  # a node comes behind the one above it
            if n[field["n_children"]] == 0:
                n[field["n_leaves"]] += 1
            n[field["saved_tokens"]] += (n[field["n_convs"]] - 1) * n[field["chars"]]
            if n[2] is not None:
                above = nodes[place[n[2], n[3]]]
                n[field["above_conv"]] = above[field["conv_id"]]
                above[field["n_children"]] += 1
                above[field["n_leaves"]] += n[field["n_leaves"]]
                above[field["saved_tokens"]] += n[field["saved_tokens"]]
        for at in range(0, len(nodes), _BATCH):
            yield _columns(nodes[at : at + _BATCH], _NODES)

    in_order = whole.coalesce(1).sortWithinPartitions("shard", F.desc("node"))
    return in_order.mapInArrow(run, _NODES_DDL)


def trie(paths: DataFrame, most: int = SKELETON, tasks: int | None = None) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    rows, size = shard_rows(paths, most, tasks)
    skeleton = materialize(reduced_skeleton(rows), "skeleton")
    local = rows.where("node >= 0")
    own = local.select(F.col("shard").alias("above_shard"), F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    under = skeleton.select(F.col("shard").alias("above_shard"), F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    keys = ["above_shard", "above"]
    below_local = local.where("above >= 0").join(own, keys)
    # The skeleton has at most SKELETON rows and one, so it may be sent to all tasks.
    below_skeleton = local.where("above < 0").join(F.broadcast(under), keys)
    found = None
    for part in (skeleton, below_local, below_skeleton):
        part = part.select(
            "conv_id", "depth", F.col("above_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.col("ends").alias("ends_sha256"),
        )
        found = part if found is None else found.unionByName(part)
    return found


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(paths_of(rebuilt(turns_of(conversations))))
