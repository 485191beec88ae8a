"""Substring deduplication with difference-cover anchors.

A window is ``window`` consecutive words of one document. Words covered by a window whose words also
start earlier (in a smaller doc_id, or earlier in the same document) go. Windows are judged on the
input.

Positions are taken modulo a period v. A difference cover D holds, for any two positions, an offset
below v that brings both into D. Two equal windows therefore share an anchor, ``window - v + 1`` words
long, that starts at a cover position in both. So only anchors at cover positions are hashed and
grouped. Around anchors that occur more than once, whole windows are hashed (96 bits) and grouped;
in each group all but the earliest go.

Each task sends one row per distinct anchor, and one per distinct window, of about a megabyte of
text; what repeats inside that megabyte is decided on the spot, and the same pass over the rows sends it along. A passage that
a third of all documents hold thus reaches a task once per megabyte, as a row, and groups are read as sorted
streams, never held. No result depends on how the rows are cut into megabytes, as long as a task that is repeated
after a loss reads its rows in the same order, as a task that reads files does.

Null and empty texts have no words. Rows that repeat an id and its text are the same document and are judged alike. Rows of
one id with different texts are different documents, ordered by a hash of their texts. Rows with a null id come before all
others, in an order given by their texts; equal ones are the same document. An empty table gives an empty result. Other
columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwatch.llm.tables import free_name, map_batches
from quillwatch.llm.text import PLAIN, hashed_words, inside, text_rows, windows
from quillwatch.operators.sequences import ranges

WINDOW = 20
_CHECK_SEED = 3


def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set of residues whose differences are all residues modulo period."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            chosen = (0, *rest)
            if len({(a - b) % period for a in chosen for b in chosen}) == period:
                return chosen
    return (0,)


def period_of(window: int) -> int:
    return max(1, 2 * window // 3)


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, str]:
    """docs with a number for each document, in the order of the ids, and the name of that column."""
    key, digest = free_name(docs, "key"), free_name(docs, "digest")
    unnamed = F.lit(-(2**62)) - F.pmod(F.xxhash64(text_column), F.lit(2**61))
    keyed = docs.withColumn(key, F.coalesce(F.col(id_column).cast("long"), unnamed))
    # Reads nothing but the ids.
    if docs.where(F.col(id_column).isNotNull()).groupBy(id_column).count().where("count > 1").isEmpty():
        return keyed, key
    hashed = keyed.withColumn(digest, F.xxhash64(text_column))
    cut = ranges(hashed.select(F.col(key).alias("k"), F.col(digest).alias("d")).distinct(), [F.col("k"), F.col("d")])
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut.groupBy("_range").agg(F.count("*").alias("n")).select("_range", before.alias("offset"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("k", "d"))
    numbers = cut.withColumn("place", place).join(offsets, "_range").select("k", "d", (F.col("place") + F.col("offset")).alias("number"))
    numbers = numbers.select(*[F.col(c).alias(free_name(hashed, c)) for c in ("k", "d", "number")])
    k, d, number = numbers.columns
    same = (F.col(key) == F.col(k)) & (F.col(digest) == F.col(d))
    return hashed.join(numbers, same).withColumn(key, F.col(number)).drop(digest, k, d, number), key


def _groups(batch: pa.RecordBatch, key: str, text_column: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per megabyte of text: row numbers, keys, words, begins, and each word's place in its text."""
    for at, texts in text_rows(batch, text_column):
        keys = batch.column(key).slice(at, len(texts)).to_numpy()
        for first, words, begins in hashed_words(texts, PLAIN):
            place = np.arange(len(words)) - np.repeat(begins[:-1], np.diff(begins))
            yield at + first, keys[first : first + len(begins) - 1], words, begins, place


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _sent(place: str, first: pa.RecordBatch, packed: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows (hash, place, key) and rows (key, places) as one kind, (hash, place, key, places). The latter are dealt out by their
    key in place of a hash. Places are bytes here: the time that Spark needs to hand lists that are mostly null to a
    task grows with the square of the batch."""
    kind = first.schema.field(place).type
    names = ["hash", place, "key", "places"]
    yield pa.RecordBatch.from_arrays([*first.columns, pa.nulls(first.num_rows, pa.binary())], names=names)
    key, places = packed.columns
    values, borders = places.values.to_numpy(), places.offsets.to_numpy()
    data = [values[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])]
    yield pa.RecordBatch.from_arrays([key, pa.nulls(packed.num_rows, kind), key, pa.array(data, pa.binary())], names=names)


def _packed(keys: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """(key, places): one row per key."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(keys)).astype(np.int32)), pa.array(places.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(keys[starts]), lists], names=["key", "places"])


def anchors(keyed: DataFrame, key: str, window: int, text_column: str) -> DataFrame:
    """Anchors at cover positions, from one pass: the first of each kind in a megabyte, as (hash, place, key), and the places of
    all that occur more than once in it, as (key, places)."""
    period = period_of(window)
    length = window - period + 1
    in_cover = np.isin(np.arange(period), difference_cover(period))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, keys, words, begins, place in _groups(batch, key, text_column):
                sizes = np.diff(begins)
                hashes = windows(words, length)
                n = len(hashes)
                doc = np.repeat(np.arange(len(sizes)), sizes)[:n]
                chosen = np.flatnonzero(in_cover[place[:n] % period] & inside(begins, len(words), length) & (sizes[doc] >= window))
                _, first, kind, counts = np.unique(hashes[chosen], return_index=True, return_inverse=True, return_counts=True)
                again = chosen[counts[kind] > 1]
                # In the order of the texts and with the key last, neighbouring rows of a shuffle differ little.
                some = np.sort(chosen[first])
                row = _batch(hash=hashes[some].view(np.int64), place=place[some].astype(np.int32), key=keys[doc[some]])
                yield from _sent("place", row, _packed(keys[doc[again]], place[again]))

    return keyed.select(key, text_column).mapInArrow(run, "hash long, place int, key long, places binary")


_FOUND = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("places", pa.list_(pa.int32()))])


def _runs(batches: Iterator[pa.RecordBatch], later_only: bool) -> Iterator[pa.RecordBatch]:
    """Of sorted rows (hash, place, key) or (hash, placed, key): those whose hash and check another row shares;
    with ``later_only`` without the first row of each run and what equals it. Rows with places come last and are passed on."""
    carried, told = None, False
    for batch in batches:
        ready = batch.filter(batch.column("places").is_valid())
        if ready.num_rows:
            key = ready.column("key")
            places = pa.array([np.frombuffer(p, dtype=np.int32) for p in ready.column("places").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([key, pa.nulls(ready.num_rows, pa.int32()), places], schema=_FOUND)
        batch = batch.slice(0, batch.num_rows - ready.num_rows)
        if not batch.num_rows:
            continue
        found, placed, key = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
        whole = placed.dtype == np.int64
        place, check = (placed >> 32, placed & 0xFFFFFFFF) if whole else (placed, np.zeros(len(placed), dtype=np.int64))
        columns = [found, check, place, key]
        if carried is not None:
            columns = [np.append(x, c) for x, c in zip(carried, columns)]
        found, check, place, key = columns
        same = (found[1:] == found[:-1]) & (check[1:] == check[:-1])
        if later_only:
            start = np.maximum.accumulate(np.where(np.append(False, same), 0, np.arange(len(key))))
            wanted = (key != key[start]) | (place != place[start])
            carried = [c[[start[-1]]] for c in columns]
        else:
            wanted = np.append(False, same) | np.append(same, False)
            last_told, wanted[0] = bool(wanted[-1]), wanted[0] and not told
            carried, told = [c[[-1]] for c in columns], last_told
        chosen = [pa.array(key[wanted]), pa.array(place[wanted].astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*chosen, pa.nulls(len(chosen[0]), pa.list_(pa.int32()))], schema=_FOUND)


def _gathered(sent: DataFrame, order: list, later_only: bool) -> DataFrame:
    """(key, places) of what ``_runs`` finds in rows that were dealt out by hash and put in order."""
    dealt = sent.repartition("hash").sortWithinPartitions(F.col("places").isNotNull(), *order)
    found = dealt.mapInArrow(lambda batches: _runs(batches, later_only), "key long, place int, places array<int>")
    both = F.concat(F.collect_list("place"), F.flatten(F.collect_list("places")))
    return found.groupBy("key").agg(both.alias("places"))


def shared_anchors(keyed: DataFrame, key: str, window: int = WINDOW, text_column: str = "text") -> DataFrame:
    """Where a document has an anchor that occurs more than once: (key, places)."""
    return _gathered(anchors(keyed, key, window, text_column), ["hash"], later_only=False)


def candidate_windows(near: DataFrame, key_column: str, places_column: str, window: int, text_column: str) -> DataFrame:
    """Windows around shared anchors, whose places ``near`` has, from one pass: the earliest of each kind in a megabyte, as
    (hash, placed, key), placed being the place and 32 bits of a second hash; and the others, as (key, places)."""
    period = period_of(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(places_column)
            for row, keys, words, begins, place in _groups(batch, key_column, text_column):
                own = lists.slice(row, len(keys))
                ends = np.cumsum(own.value_lengths().fill_null(0).to_numpy())
                places = own.flatten().to_numpy()
                doc = np.repeat(np.arange(len(keys)), np.diff(np.append(0, ends)))
                fits = places < np.diff(begins)[doc]
                marks = np.zeros(len(words) + 1, dtype=np.int32)
                at = begins[doc[fits]] + places[fits]
                np.add.at(marks, np.maximum(begins[doc[fits]], at - period + 1), 1)
                np.add.at(marks, at + 1, -1)
                n = max(0, len(words) - window + 1)
                chosen = np.flatnonzero((np.cumsum(marks)[:n] > 0) & inside(begins, len(words), window))
                hashes = windows(words, window)[chosen]
                checks = (windows(words, window, _CHECK_SEED)[chosen] >> np.uint64(32)).astype(np.uint32)
                doc = np.repeat(np.arange(len(keys)), np.diff(begins))[:n][chosen]
                key, spot = keys[doc], place[:n][chosen].astype(np.int32)
                order = np.lexsort((spot, key, checks, hashes))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])
                start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else order
                first = order[start]
                later = (key[order] != key[first]) | (spot[order] != spot[first])
                some = np.sort(order[new])
                placed = (spot[some].astype(np.int64) << 32) | checks[some].astype(np.int64)
                earliest = _batch(hash=hashes[some].view(np.int64), placed=placed, key=key[some])
                yield from _sent("placed", earliest, _packed(key[order][later], spot[order][later]))

    return near.mapInArrow(run, "hash long, placed long, key long, places binary")


def _placed(keyed: DataFrame, key: str, places: DataFrame) -> tuple[DataFrame, str]:
    """keyed with a list of places, and the name of that column. The same left join of the same columns each time, so
    Spark deals out the texts once."""
    name, at = free_name(keyed, "places"), free_name(keyed, "at")
    some = places.select(F.col("key").alias(at), F.col("places").alias(name))
    joined = keyed.join(some, F.col(key) == F.col(at), "left").drop(at)
    return joined.withColumn(name, F.coalesce(name, F.array().cast("array<int>"))), name


def repeated_windows(keyed: DataFrame, key: str, window: int = WINDOW, text_column: str = "text") -> DataFrame:
    """Where windows start whose words also start earlier: (key, places)."""
    near, places = _placed(keyed, key, shared_anchors(keyed, key, window, text_column))
    sent = candidate_windows(near, key, places, window, text_column)
    check = F.col("placed").bitwiseAND(F.lit(0xFFFFFFFF))
    return _gathered(sent, ["hash", check, "key", "placed"], later_only=True)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with the words that stay as text, joined by one space, and n_words before and n_removed."""
    n_words, n_removed = (free_name(docs, c) for c in ("n_words", "n_removed"))
    keyed, key = _keyed(docs, id_column, text_column)
    joined, places_column = _placed(keyed, key, repeated_windows(keyed, key, window, text_column))
    joined = joined.drop(key)

    def rewrite(batch: pa.RecordBatch) -> list[pa.Array]:
        kept, before, removed = [], [], []
        for at, texts in text_rows(batch, text_column):
            for text, places in zip(texts, batch.column(places_column).slice(at, len(texts))):
                words = text.split()
                goes = np.zeros(len(words) + 1, dtype=np.int32)
                if len(places):
                    starts = np.unique(places.values.to_numpy())
                    starts = starts[starts + window <= len(words)]
                    goes[starts] += 1
                    goes[starts + window] -= 1
                stays = np.flatnonzero(np.cumsum(goes)[:-1] == 0)
                kept.append(b" ".join(words if len(stays) == len(words) else [words[i] for i in stays.tolist()]))
                before.append(len(words))
                removed.append(len(words) - len(stays))
        return [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()), pa.array(removed, pa.int64())]

    added = T.StructType([T.StructField(text_column, T.StringType()), T.StructField(n_words, T.LongType()), T.StructField(n_removed, T.LongType())])
    return map_batches(joined, rewrite, added).select(*docs.columns, n_words, n_removed)
