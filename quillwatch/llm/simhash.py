"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits: bit i is set where more than half of the shingles' hashes have it set.
Distinct fingerprints are compared, never documents, so copies cost nothing. Fingerprints link where
at most ``distance`` bits differ. The bits are cut into segments with a radius each, the radii plus
one adding up to more than ``distance``: fingerprints that link agree in some segment up to its
radius. Every fingerprint is filed under each segment's value and looked up under all values in the
Hamming ball around it; what shares an entry is compared in full. Wider segments mean more look-ups
and fewer chance meetings: ``plan`` picks the cheapest cut for the number of fingerprints, all cuts
giving the same links.

Table entries are split by their number of members into blocks before they meet, so a large group of
near copies is spread over tasks. A task returns a spanning forest of the links it finds instead of
all of them, and connected components are taken over those in Spark.

Null and empty texts have fingerprint zero and link like any other. Rows that repeat an id are judged
each by its text. A component's id is its smallest doc_id, null where all are null. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.llm.components import components
from quillwatch.llm.tables import free_name
from quillwatch.llm.text import mix, text_rows
from quillwatch.session import materialize

SEED = 42
DISTANCE = 4
WORDS = 4
_STEP = 255  # hashes whose bits are counted in bytes
_MEMBERS = 4096  # filed fingerprints of an entry that meet in one task
_ENTRY = 16_384  # the same where all are filed under all values they are looked up by
_LOOKUP_COST, _MEETING_COST = 300, 1

_SPREAD = np.zeros(256, dtype=np.uint64)
for _byte in range(256):
    _SPREAD[_byte] = sum(1 << (8 * bit) for bit in range(8) if _byte >> bit & 1)


def shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """XXH64 of every k consecutive words, a block at a time; of all words where there are fewer."""
    words = text.lower().split()
    n = max(len(words) - k + 1, 1 if words else 0)
    if not n:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - [len(w) + 1 for w in words]
    last = ends[k - 1 :] - 1 if len(words) >= k else ends[-1:] - 1
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        some = zip(starts[at : min(n, at + (1 << 16))].tolist(), last[at : at + (1 << 16)].tolist())
        yield np.array([hashed(joined[s:e], SEED) for s, e in some], dtype=np.uint64)


def majority(kinds: list[np.ndarray]) -> tuple[int, ...]:
    """Per array of hashes: the bits that more than half of them have."""
    out = []
    for some in kinds:
        spread = _SPREAD[some.astype("<u8").view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(spread, np.arange(0, len(some), _STEP), axis=0) if len(some) else spread
        counts = sums.astype("<u8").view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
        out.append(sum(1 << i for i in np.flatnonzero(2 * counts > len(some)).tolist()))
    return tuple(out)


def fingerprint(text: bytes, k: int = WORDS, again: bool = False) -> tuple[int, int]:
    """The 64 bits, and with ``again`` 64 more from the hashes of the hashes (else 0)."""
    counts, n = np.zeros((2, 64), dtype=np.int64), 0
    for hashes in shingle_hashes(text, k):
        n += len(hashes)
        for i, some in enumerate((hashes, mix(hashes)) if again else (hashes,)):
            spread = _SPREAD[some.astype("<u8").view(np.uint8).reshape(-1, 8)]
            sums = np.add.reduceat(spread, np.arange(0, len(some), _STEP), axis=0)
            counts[i] += sums.astype("<u8").view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return tuple(sum(1 << i for i in np.flatnonzero(2 * c > n).tolist()) for c in counts)


def fingerprints(docs: DataFrame, k: int = WORDS, id_column: str = "doc_id", text_column: str = "text", again: bool = False) -> DataFrame:
    """(doc_id, fp, fp2) per document, the bits as signed numbers."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_rows(batch, "text"):
                found = np.array([fingerprint(t, k, again) for t in texts], dtype=np.uint64).view(np.int64)
                ids = batch.column("doc_id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found[:, 0]), pa.array(found[:, 1])], names=["doc_id", "fp", "fp2"])

    return rows.mapInArrow(run, "doc_id long, fp long, fp2 long")


def cut(segments: int, distance: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each segment; segments that need no look-up for this distance are left out."""
    radii = [-1] * segments
    for i in range(distance + 1):
        radii[i % segments] += 1
    borders = [64 * i // segments for i in range(segments + 1)]
    return [(lo, hi - lo, r) for lo, hi, r in zip(borders, borders[1:], radii) if r >= 0]


def ball_size(bits: int, radius: int) -> int:
    return sum(comb(bits, i) for i in range(radius + 1))


def plan(n: int, distance: int) -> list[tuple[int, int, int]]:
    """The cut that costs n fingerprints the least in look-ups and expected chance meetings, of those that enumerate a
    ball in segments of a dozen bits or more. It changes only beyond some 18 million distinct fingerprints."""
    def cost(segments: list[tuple[int, int, int]]) -> float:
        return sum(ball_size(bits, r) * (_LOOKUP_COST + _MEETING_COST * n / 2**bits) for _, bits, r in segments)

    return min((cut(m, distance) for m in range(2, min(max(2, distance), 5) + 1)), key=cost)


def masks(bits: int, radius: int) -> np.ndarray:
    """All values within the radius of zero, zero first."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=np.uint64)


def entries(fps: DataFrame, segments: list[tuple[int, int, int]]) -> DataFrame:
    """(segment, value, fp, fp2, filed): where a fingerprint is filed, and where it is looked up besides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [masks(bits, radius) for _, bits, radius in segments]
        rows = max(1, (1 << 18) // max(map(len, balls)))
        for batch in batches:
            some = np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns], axis=1)
            for part, second in (x.T for x in np.array_split(some, -(-len(some) // rows) or 1)):
                for i, ((first, bits, _), around) in enumerate(zip(segments, balls)):
                    value = (part >> np.uint64(first)) & np.uint64((1 << bits) - 1)
                    values = (value[:, None] ^ around).ravel()
                    filed = np.zeros(len(values), dtype=bool)
                    filed[:: len(around)] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), i, dtype=np.int32)), pa.array(values.view(np.int64)),
                         *(pa.array(np.repeat(x, len(around)).view(np.int64)) for x in (part, second)), pa.array(filed)],
                        names=["segment", "value", "fp", "fp2", "filed"],
                    )

    return fps.select("fp", "fp2").mapInArrow(run, "segment int, value long, fp long, fp2 long, filed boolean")


def forest_links(fp: np.ndarray, fp2: np.ndarray, at_home: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links between the fingerprints filed here and all that are looked up with them, reduced to a spanning forest."""
    filed, filed2, others = fp[at_home], fp2[at_home], fp
    nodes = np.unique(np.concatenate([filed, others]))
    labels, place, home = np.arange(len(nodes)), np.searchsorted(nodes, others), np.searchsorted(nodes, filed)
    rows = max(1, (1 << 20) // max(1, len(filed)))
    for at in range(0, len(others), rows):
        apart = np.bitwise_count(others[at : at + rows, None] ^ filed)
        near = apart + np.bitwise_count(fp2[at : at + rows, None] ^ filed2) <= distance
        for i in np.flatnonzero(near.any(1)):
            mine, there = labels[place[at + i]], home[near[i]]
            joined, which = np.unique(labels[there], return_index=True)
            if len(joined) == 1 and joined[0] == mine:
                continue
            for label, j in zip(joined.tolist(), there[which].tolist()):
                if label != mine:
                    yield int(others[at + i]), int(nodes[j])
            labels[np.isin(labels, joined) | (labels == mine)] = min(mine, joined[0])


def link_fingerprints(fps: DataFrame, distance: int = DISTANCE, segments: list[tuple[int, int, int]] | None = None, most: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints (fp, fp2), enough of them to connect all that are connected.

    All that differ in at most ``distance`` bits of fp meet. Those that meet link where at most ``most`` bits of
    both numbers differ (default: ``distance``, fp2 being 0)."""
    segments = segments or plan(fps.count(), distance)
    most = distance if most is None else most
    found = materialize(entries(fps, segments), "entries")
    # An entry with many filed members is cut into blocks of them; whoever looks there visits every block.
    large = found.where("filed").groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > _MEMBERS)
    large = large.select("segment", "value", F.ceil(F.col("n") / _MEMBERS).cast("int").alias("blocks"))
    found = found.join(large, ["segment", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.when(F.col("filed"), F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).otherwise(-1)
    found = found.select("segment", "value", "fp", "fp2", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    found = found.repartition("segment", "value", "block").sortWithinPartitions("segment", "value", "block", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, columns in groups(batches, 3):
            fp, fp2, own = columns[0].view(np.uint64), columns[1].view(np.uint64), columns[2]
            at_home = own == keys[2]
            if len(fp) > 1 and at_home.any():
                links = list(forest_links(fp, fp2, at_home, most))
                if links:
                    a, b = (pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in zip(*links))
                    yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return found.select("segment", "value", "block", "fp", "fp2", "own").mapInArrow(run, "a long, b long")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """Runs of equal leading ``keys`` integer columns in sorted batches, with the remaining columns of each run."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate([r, c]) for r, c in zip(rest, columns)]
        if not len(columns[0]):
            continue
        new = np.zeros(len(columns[0]), dtype=bool)
        for c in columns[:keys]:
            new[1:] |= c[1:] != c[:-1]
        borders = [0, *np.flatnonzero(new).tolist()]
        for lo, hi in zip(borders, borders[1:]):
            yield tuple(int(c[lo]) for c in columns[:keys]), [c[lo:hi] for c in columns[keys:]]
        rest = [c[borders[-1] :] for c in columns]
    if rest is not None and len(rest[0]):
        yield tuple(int(c[0]) for c in rest[:keys]), rest[keys:]


def classes(docs: DataFrame, k: int = WORDS, distance: int = DISTANCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per document."""
    marked = materialize(fingerprints(docs, k, id_column, text_column), "fingerprints")
    fps = materialize(marked.groupBy("fp", "fp2").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = materialize(components(link_fingerprints(fps, distance)), "roots")
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = fps.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    names = fps.select("fp", "root").join(firsts, "root").select("fp", "component_id")
    return marked.join(names, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: bytes, k: int) -> np.ndarray:
    found = list(shingle_hashes(text, k))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def similarity(one: np.ndarray, two: np.ndarray) -> float:
    """Jaccard similarity of sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(one, two, assume_unique=True))
    total = len(one) + len(two) - both
    return both / total if total else 1.0


def similar_pairs(pairs: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """Of pairs (a, b) of keys: those whose texts have at least this similarity of k-word shingles."""
    texts = texts.select(F.col("key"), F.col("text"))
    with_a = pairs.join(texts, F.col("a") == F.col("key")).select("a", "b", F.col("text").alias("text_a"))
    both = with_a.join(texts, F.col("b") == F.col("key")).select("a", "b", "text_a", F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for (at, some), (_, others) in zip(text_rows(batch, "text_a", 32), text_rows(batch, "text_b", 32)):
                for i, (one, two) in enumerate(zip(some, others)):
                    if one == two or similarity(shingle_set(one, k), shingle_set(two, k)) >= least:
                        kept.append(at + i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return both.mapInArrow(run, "a long, b long")


def set_fingerprints(texts: DataFrame, k: int) -> DataFrame:
    """(key, fp, fp2, size, digest) of (key, text): all from the text's set of shingles, however often it repeats them.
    Equal digests are equal sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, some in text_rows(batch, "text"):
                sets = [shingle_set(t, k) for t in some]
                found = np.array([majority([x, mix(x)]) for x in sets], dtype=np.uint64).view(np.int64)
                digests = [hashlib.blake2b(x.astype("<u8").tobytes(), digest_size=16).digest() for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(some)), pa.array(found[:, 0]), pa.array(found[:, 1]),
                     pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary())],
                    names=["key", "fp", "fp2", "size", "digest"],
                )

    return texts.mapInArrow(run, "key long, fp long, fp2 long, size long, digest binary")


def meetings(elements: DataFrame, distance: int) -> DataFrame:
    """(segment, value, block, own, and the columns of elements): elements (node, fp, fp2, ...) filed in every segment under
    all values that differ in at most one bit. Two that agree in some segment up to two bits share an entry, so all within
    ``distance`` bits of fp do. Entries of many are cut into blocks; each element has its own and visits all."""
    segments, names = cut(distance // 3 + 1, distance), elements.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [masks(bits, 1) for _, bits, _ in segments]
        rows = (1 << 18) // max(map(len, balls))
        for batch in batches:
            every = np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns], axis=1)
            for some in np.array_split(every, -(-len(every) // rows) or 1):
                for i, ((first, bits, _), around) in enumerate(zip(segments, balls)):
                    values = ((some[:, 1] >> np.uint64(first) & np.uint64((1 << bits) - 1))[:, None] ^ around).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), i, dtype=np.int32)), pa.array(values.view(np.int64)),
                         *(pa.array(np.repeat(x, len(around)).view(np.int64)) for x in some.T)],
                        names=["segment", "value", *names],
                    )

    filed = elements.mapInArrow(run, ", ".join(["segment int", "value long", *(f"{n} long" for n in names)]))
    # At most one row per entry, of which there are a few thousand per segment whatever the input.
    large = filed.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > _ENTRY)
    large = large.select("segment", "value", F.ceil(F.col("n") / _ENTRY).cast("int").alias("blocks"))
    filed = filed.join(F.broadcast(large), ["segment", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    filed = filed.select("segment", "value", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), own, *names)
    return filed.repartition("segment", "value", "block").sortWithinPartitions("segment", "value", "block", "node", "fp", "fp2")


def near(fp: np.ndarray, fp2: np.ndarray, some: np.ndarray, others: np.ndarray, distance: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of some and of others that are close by both bounds, the pairs of a few of ``some`` at a time."""
    rows = max(1, (1 << 20) // max(1, len(others)))
    for at in range(0, len(some), rows):
        mine = some[at : at + rows]
        apart = np.bitwise_count(fp[mine, None] ^ fp[others])
        close = (apart <= distance) & (apart + np.bitwise_count(fp2[mine, None] ^ fp2[others]) <= most)
        i, j = np.nonzero(close)
        yield mine[i], others[j]


def _pairs(links: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if links:
        a, b = (pa.array(np.concatenate(x).view(np.int64)) for x in zip(*links))
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def loose_forest(elements: DataFrame, distance: int, most: int) -> DataFrame:
    """(a, b): enough of the close pairs of elements (node, fp, fp2) to connect all that close pairs connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, (own, node, fp, fp2) in groups(batches, 3):
            fp, fp2, home = fp.view(np.uint64), fp2.view(np.uint64), np.flatnonzero(own == key[2])
            labels, links = np.arange(len(node)), []
            for some, others in near(fp, fp2, np.arange(len(node)), home, distance, most):
                others, some = others[some != others], some[some != others]
                for i, theirs in zip(np.unique(some), np.split(others, np.flatnonzero(np.diff(some)) + 1)):
                    joined, which = np.unique(labels[theirs], return_index=True)
                    if len(joined) == 1 and joined[0] == labels[i]:
                        continue
                    new = theirs[which[joined != labels[i]]]
                    links.append((np.repeat(node[i], len(new)), node[new]))
                    labels[np.isin(labels, joined) | (labels == labels[i])] = min(labels[i], joined[0])
            yield from _pairs(links)

    return meetings(elements, distance).mapInArrow(run, "a long, b long")


def open_pairs(elements: DataFrame, distance: int, most: int, least: float) -> DataFrame:
    """(a, b), once each: all close pairs of elements (node, fp, fp2, size, label) with different labels whose sizes allow
    this similarity."""
    segments = cut(distance // 3 + 1, distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (segment, value, block), (own, node, fp, fp2, size, label) in groups(batches, 3):
            at_home, names = own == block, np.unique(label)
            if len(names) < 2:
                continue
            fp, fp2 = fp.view(np.uint64), fp2.view(np.uint64)
            for name in names:
                mine, others = np.flatnonzero(label == name), np.flatnonzero(at_home & (label != name))
                for some, with_ in near(fp, fp2, mine, others, distance, most):
                    good = (node[some] < node[with_]) & (np.minimum(size[some], size[with_]) >= least * np.maximum(size[some], size[with_]) - 1e-6)
                    some, with_ = some[good], with_[good]
                    # A pair meets in several entries and is told in one: in the first segment where it does, under the
                    # value that differs from the first of them in no bit, or in the lowest where two bits differ.
                    told = np.ones(len(some), dtype=bool)
                    for i, (first, bits, _) in enumerate(segments[: segment + 1]):
                        apart = (fp[some] ^ fp[with_]) >> np.uint64(first) & np.uint64((1 << bits) - 1)
                        n = np.bitwise_count(apart)
                        if i < segment:
                            told &= n > 2
                        else:
                            here = fp[some] >> np.uint64(first) & np.uint64((1 << bits) - 1)
                            low = apart & (~apart + np.uint64(1))
                            told &= np.where(n < 2, here, here ^ low) == np.uint64(value)
                    if told.any():
                        yield from _pairs([(node[some[told]], node[with_[told]])])

    return meetings(elements, distance).mapInArrow(run, "a long, b long")


def drop_near_copies(docs: DataFrame, k: int = 5, distance: int = 14, most: int = 28, least: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without near copies of a smaller one, with their columns.

    Documents with one set of shingles are one; fingerprints are those of the sets. Two sets are close where at most
    ``distance`` of 64 bits and at most ``most`` of 128 bits differ, whatever else the table holds. Close sets link
    where their texts have at least this similarity, and of each group of linked documents the one with the smallest
    id stays. First the texts of a spanning forest of the close pairs are compared, then those of every close pair
    that the links found so far leave apart. Rows with a null id are told apart by their texts and come first; rows
    that repeat an id share its fate."""
    key = free_name(docs, "key")
    unnamed = F.lit(-(2**62)) - F.pmod(F.xxhash64(text_column), F.lit(2**61))
    keyed = docs.withColumn(key, F.coalesce(F.col(id_column).cast("long"), unnamed))
    texts = keyed.select(F.col(key).alias("key"), F.col(text_column).alias("text"))
    marked = materialize(set_fingerprints(texts, k).distinct(), "fingerprints")
    sets = marked.groupBy("digest").agg(F.min("key").alias("node"), *[F.first(c).alias(c) for c in ("fp", "fp2", "size")])
    sets = materialize(sets, "shingle-sets")
    copies = marked.join(sets.select("digest", "node"), "digest").where("key != node").select("key", "node")
    copies = materialize(copies, "copies")
    firsts = materialize(sets.groupBy("fp", "fp2").agg(F.min("node").alias("node")).select("node", "fp", "fp2"), "distinct-fingerprints")
    links = materialize(loose_forest(firsts, distance, most), "fingerprint-links")
    roots = materialize(components(links), "roots")
    # Every set with the first of its fingerprint and the smallest of its group of close fingerprints.
    placed = sets.join(firsts.withColumnRenamed("node", "first"), ["fp", "fp2"])
    placed = placed.join(roots.select(F.col("node").alias("first"), "root"), "first", "left").withColumn("root", F.coalesce("root", "first"))
    placed = materialize(placed.select("node", "fp", "fp2", "size", "first", "root"), "placed")
    pairs = placed.select(F.col("node").alias("a"), F.col("first").alias("b")).union(placed.select("first", "root")).union(links)
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    groups_ = placed.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    members = placed.join(groups_, "root", "left_semi").select(F.col("node").alias("member")).distinct()
    members = materialize(texts.join(members, F.col("key") == F.col("member"), "left_semi").distinct(), "near-texts")
    alike = materialize(similar_pairs(materialize(pairs, "near-pairs"), members, k, least), "alike")
    labels = components(alike).withColumnRenamed("root", "label")
    placed = placed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = materialize(placed.select("node", "fp", "fp2", "size", "label", "root"), "labelled")
    apart = placed.groupBy("root").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    left = placed.join(apart, "root", "left_semi").select("node", "fp", "fp2", "size", "label")
    left = materialize(left, "unsettled")
    rest = materialize(open_pairs(left, distance, most, least).join(pairs, ["a", "b"], "left_anti"), "open-pairs")
    # An id that repeats may be a copy with one text and have links with another.
    both = copies.join(sets.select("node").distinct().withColumnRenamed("node", "key"), "key", "left_semi")
    found = alike.union(similar_pairs(rest, members, k, least)).union(both.select("key", "node"))
    gone = components(found).where("node != root").select(F.col("node").alias("key"))
    gone = materialize(gone.union(copies.select("key")).distinct(), "near-copies")
    copy = free_name(keyed, "copy")
    return keyed.join(gone.select(F.col("key").alias(copy)), F.col(key) == F.col(copy), "left_anti").select(*docs.columns)


def hex_of(fp):
    """A signed number's 64 bits as 16 hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
