"""Reversible line deduplication: sharded cuckoo filters backed by exact reference counts.

A text is split at line breaks (null or empty: one empty line). A line's key is the line with blanks
stripped at both ends and A-Z lower-cased; keys of at least ``MIN_CHARS`` code points count. A store
holds three tables:

- ``postings`` (key, doc_id): which document holds which key, once each;
- ``refs`` (key, n_docs, first_doc): in how many documents a key is, and the smallest of them;
- ``filters`` (shard, cuckoo filter): fingerprints of the keys that are in two documents or more.

``insert`` adds documents and ``delete`` takes documents away again; both put exactly the keys whose
count crosses two into their shard's filter or out of it, so that deleting what was inserted restores
the earlier answers. When the keys outgrow the shards, all filters are built anew in more of them. ``clean`` asks the filters first: a line that its shard's filter does not know
stays. What the filter knows is confirmed by the exact counts, and lines of a key held by several
documents stay in the smallest doc_id only.

Keys held by more than one document in ``HOT`` of all postings, fewer than ``HOT`` of them, bypass the
filters through a broadcast, so no shard receives the lines of a key that a third of all documents
hold. Shards are Arrow tables in the tasks, whose workers never load pandas. Keys are 128-bit digests. Rows that repeat an id are one document to the counts, as are the rows
with a null id, which come after all others. An empty table makes an empty store. Other columns pass
through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwatch.llm.tables import free_name, map_batches
from quillwatch.llm.text import BLANKS, mix, text_rows
from quillwatch.session import materialize

MIN_CHARS = 10
HOT = 20_000
SHARD_KEYS = 50_000
_SLOTS = 4


def line_key(line: bytes) -> bytes | None:
    """Digest of the line's key, or None for a key too short to count."""
    key = line.strip(BLANKS).lower()
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and len(key.decode()) < MIN_CHARS):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """Buckets of four 16-bit fingerprints (0: free). An entry may be in either of two buckets, each found
    from the other and the fingerprint, so entries can be moved and deleted. Grows by rebuilding from the
    exact keys, which is the caller's business: ``add`` returns False when it finds no room."""

    def __init__(self, keys: int = 0, table: bytes | None = None) -> None:
        if table is None:
            buckets = 1 << max(3, int(np.ceil(np.log2(max(1, keys) / (_SLOTS * 0.85)))))
            self.table = np.zeros((buckets, _SLOTS), dtype=np.uint16)
        else:
            self.table = np.frombuffer(table, dtype=np.uint16).reshape(-1, _SLOTS).copy()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of 64-bit keys."""
        mask = np.uint64(len(self.table) - 1)
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = mix(keys) & mask
        return prints, one.astype(np.int64), ((one ^ mix(prints.astype(np.uint64))) & mask).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        prints, one, two = self.places(keys)
        return (self.table[one] == prints[:, None]).any(1) | (self.table[two] == prints[:, None]).any(1)

    def add(self, keys: np.ndarray) -> bool:
        mask = len(self.table) - 1
        turn = 0
        for entry, one, two in zip(*(a.tolist() for a in self.places(keys))):
            at = one
            for bucket in (one, two):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = entry
                    break
            else:
                for _ in range(500):
                    turn = (turn + 1) % _SLOTS
                    entry, self.table[at, turn] = int(self.table[at, turn]), entry
                    at = (at ^ int(mix(np.array([entry], dtype=np.uint64))[0])) & mask
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = entry
                        break
                else:
                    return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        """Take out one entry for each key; the keys must have been added."""
        for entry, one, two in zip(*(a.tolist() for a in self.places(keys))):
            for bucket in (one, two):
                held = np.flatnonzero(self.table[bucket] == entry)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = len(keys)
        while True:
            built = cls(size)
            if built.add(keys):
                return built
            size = 2 * size + _SLOTS


@dataclass
class LineStore:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int


def save(store: LineStore, path: str) -> None:
    """Keep the store under ``path``, which must not hold one yet; each state of it is a folder of its own."""
    spark = store.refs.sparkSession
    for name in ("postings", "refs", "filters"):
        getattr(store, name).write.parquet(f"{path}/{name}")
    spark.range(1).select(F.lit(store.shards).alias("shards")).write.parquet(f"{path}/shards")


def load(spark: SparkSession, path: str) -> LineStore:
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return LineStore(read("postings"), read("refs"), read("filters"), read("shards").first()[0])


def postings_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(key, doc_id) of every line that counts, once per document."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_rows(batch, "text"):
                keys = [{k for k in map(line_key, t.split(b"\n")) if k} for t in texts]
                ids = np.repeat(np.arange(len(texts)), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for some in keys for k in some], pa.binary()), batch.column("doc_id").slice(at, len(texts)).take(pa.array(ids))],
                    names=["key", "doc_id"],
                )

    return rows.mapInArrow(run, "key binary, doc_id long")


def _counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


def _shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


def _key64(keys: pa.ChunkedArray) -> np.ndarray:
    """The first half of every key."""
    out = [np.zeros(0, dtype=np.uint64)]
    for chunk in keys.chunks:
        if len(chunk):
            halves = np.frombuffer(chunk.cast(pa.binary(16)).buffers()[1], dtype=np.uint64)
            out.append(halves[: 2 * len(chunk) : 2])
    return np.concatenate(out)


def _filter_row(shard: int, table: np.ndarray | None) -> pa.Table:
    held = None if table is None else table.tobytes()
    return pa.Table.from_arrays([pa.array([shard], pa.int32()), pa.array([held], pa.binary())], names=["shard", "filter"])


def _held(filters: pa.Table) -> CuckooFilter:
    return CuckooFilter(table=filters.column("filter")[0].as_py())


def _built(refs: DataFrame, shards: int) -> DataFrame:
    """Filters over the keys that two documents or more hold."""
    repeated = refs.where("n_docs > 1").select(_shard(shards).alias("shard"), "key")

    def build(group: pa.Table) -> pa.Table:
        return _filter_row(group.column("shard")[0].as_py(), CuckooFilter.of(_key64(group.column("key"))).table)

    return repeated.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def _updated(filters: DataFrame, changes: DataFrame, refs: DataFrame, shards: int) -> DataFrame:
    """Filters after ``changes`` (key, crossed: 1 into the filter, -1 out of it); a full one is built anew from refs."""
    changed = changes.select(_shard(shards).alias("shard"), "key", "crossed")

    def update(key, left: pa.Table, right: pa.Table) -> pa.Table:
        held = _held(left) if left.num_rows else CuckooFilter(2 * right.num_rows)
        keys, crossed = _key64(right.column("key")), right.column("crossed").to_numpy()
        held.remove(keys[crossed < 0])
        full = not held.add(keys[crossed > 0])
        return _filter_row(key[0].as_py(), None if full else held.table)

    out = filters.groupBy("shard").cogroup(changed.groupBy("shard")).applyInArrow(update, "shard int, filter binary")
    out = materialize(out, "line-filters-updated")
    full = out.where("filter is null").select("shard")
    again = refs.join(full, _shard(shards) == F.col("shard"), "left_semi")
    return out.where("filter is not null").unionByName(_built(again, shards))


def empty(docs: DataFrame) -> LineStore:
    spark = docs.sparkSession
    return LineStore(spark.createDataFrame([], "key binary, doc_id long"), spark.createDataFrame([], "key binary, n_docs long, first_doc long"),
                     spark.createDataFrame([], "shard int, filter binary"), 0)


def insert(store: LineStore | None, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineStore:
    """The store with the documents added. Lines of a document that is already there are added to it."""
    new = postings_of(docs, id_column, text_column).distinct()
    if store is None or not store.shards:
        postings = materialize(new, "postings")
        refs = materialize(_counts(postings), "refs")
        shards = max(1, -(-refs.count() // SHARD_KEYS))
        return LineStore(postings, refs, materialize(_built(refs, shards), "line-filters"), shards)
    both = new.alias("n").join(store.postings.alias("p"), F.col("n.key").eqNullSafe(F.col("p.key")) & F.col("n.doc_id").eqNullSafe(F.col("p.doc_id")), "left_anti")
    added = materialize(both, "added")
    postings = materialize(store.postings.unionByName(added), "postings")
    refs = store.refs.unionByName(_counts(added)).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))
    return _crossed(store, postings, materialize(refs, "refs"))


def delete(store: LineStore, ids: DataFrame, id_column: str = "doc_id") -> LineStore:
    """The store without the documents of these ids."""
    gone = ids.select(F.col(id_column).cast("long").alias("gone")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone"))
    postings = materialize(store.postings.join(gone, same, "left_anti"), "postings")
    touched = store.postings.join(gone, same, "left_semi").select("key").distinct()
    touched = materialize(touched, "touched")
    # Only keys of deleted documents are counted again.
    refs = store.refs.join(touched, "key", "left_anti").unionByName(_counts(postings.join(touched, "key", "left_semi")))
    return _crossed(store, postings, materialize(refs, "refs"))


def _crossed(store: LineStore, postings: DataFrame, refs: DataFrame) -> LineStore:
    needed = -(-refs.count() // SHARD_KEYS)
    if needed > store.shards:
        # Twice as many at least, so that small insertions rarely build all filters anew.
        shards = max(needed, 2 * store.shards)
        return LineStore(postings, refs, materialize(_built(refs, shards), "line-filters"), shards)
    before, after = store.refs.where("n_docs > 1").select("key", F.lit(-1).alias("crossed")), refs.where("n_docs > 1").select("key", F.lit(1).alias("crossed"))
    changes = before.unionByName(after).groupBy("key").agg(F.sum("crossed").alias("crossed")).where("crossed != 0")
    filters = materialize(_updated(store.filters, changes, refs, store.shards), "line-filters")
    return LineStore(postings, refs, filters, store.shards)


def repeated_lines(store: LineStore, lines: DataFrame) -> DataFrame:
    """Of lines (key, doc_id): those whose key several documents hold, and not this one as the smallest."""
    total = store.postings.count()
    hot = materialize(store.refs.where(F.col("n_docs") * HOT > total), "hot-lines")
    drops = ~F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("n_docs") > 1)
    busy = lines.join(F.broadcast(hot), "key").where(drops).select("key", "doc_id")
    cold = lines.join(F.broadcast(hot.select("key")), "key", "left_anti")
    cold = cold.select(_shard(max(1, store.shards)).alias("shard"), "key", "doc_id")

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.zeros(right.num_rows, dtype=bool)
        if left.num_rows and right.num_rows:
            known = _held(left).has(_key64(right.column("key")))
        return right.select(["key", "doc_id"]).filter(pa.array(known))

    maybe = store.filters.groupBy("shard").cogroup(cold.groupBy("shard")).applyInArrow(probe, "key binary, doc_id long")
    exact = maybe.join(store.refs.where("n_docs > 1"), "key").where(drops).select("key", "doc_id")
    return busy.unionByName(exact)


def clean(store: LineStore, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          postings: DataFrame | None = None) -> DataFrame:
    """docs with their lines judged by the store: the text without the lines that go, n_lines before and n_dropped.

    ``postings`` may hand over what ``postings_of(docs)`` gives, where it has been written already."""
    n_lines, n_dropped, own_id, goes = (free_name(docs, c) for c in ("n_lines", "n_dropped", "dropped_id", "drops"))
    lines = postings if postings is not None else materialize(postings_of(docs, id_column, text_column), "lines")
    drops = repeated_lines(store, lines).groupBy("doc_id").agg(F.collect_set("key").alias(goes))
    joined = docs.alias("d").join(drops.select(F.col("doc_id").alias(own_id), goes), F.col(f"d.{id_column}").eqNullSafe(F.col(own_id)), "left")
    joined = joined.select("d.*", goes)

    def rewrite(batch: pa.RecordBatch) -> list[pa.Array]:
        kept, before, dropped = [], [], []
        for at, texts in text_rows(batch, text_column):
            for text, go in zip(texts, batch.column(goes).slice(at, len(texts)).to_pylist()):
                lines = text.split(b"\n")
                stay = lines
                if go:
                    gone = set(go)
                    stay = [x for x in lines if line_key(x) not in gone]
                kept.append(b"\n".join(stay) if go else text)
                before.append(len(lines))
                dropped.append(len(lines) - len(stay))
        return [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]

    added = T.StructType([T.StructField(text_column, T.StringType()), T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])
    return map_batches(joined, rewrite, added).select(*docs.columns, n_lines, n_dropped)
