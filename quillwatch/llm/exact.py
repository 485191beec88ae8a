"""Exact deduplication with a split of heavy hitters.

Texts are equal when they are identical after lower-casing A-Z. A Misra-Gries summary per task,
merged in Spark, names at most ``counters`` candidates for digests that hold more than one part in
``counters`` of all rows. Candidates are counted exactly; the verified winners, at most ``counters``
rows, are broadcast and decide their copies without a shuffle. All other digests are grouped by an
ordinary shuffle, in which no digest holds more than that part of the rows.

Null text counts as empty text. Of equal texts the largest id stays, null being the smallest id; of
rows that repeat id and text, one stays. An empty table gives an empty result. Other columns are
never read by ``mark_copies`` and pass through ``drop_copies``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwatch.llm.tables import free_name, map_batches
from quillwatch.llm.text import text_rows
from quillwatch.session import materialize

COUNTERS = 1024


def with_digest(docs: DataFrame, column: str, text_column: str = "text") -> DataFrame:
    """docs with the SHA-256 of the normalised text as 32 bytes."""

    def digests(batch: pa.RecordBatch) -> list[pa.Array]:
        found: list[bytes] = []
        for _, texts in text_rows(batch, text_column):
            found += [hashlib.sha256(t.lower()).digest() for t in texts]
        return [pa.array(found, pa.binary())]

    return map_batches(docs, digests, T.StructType([T.StructField(column, T.BinaryType())]))


def misra_gries(values: Iterator[list], counters: int) -> dict:
    """Counters that hold every value making up more than one part in counters + 1 of the stream."""
    held: Counter = Counter()
    for some in values:
        held.update(some)
        if len(held) > counters:
            least = held.most_common(counters + 1)[-1][1]
            held = Counter({v: n - least for v, n in held.items() if n > least})
    return held


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Candidates for frequent digests, at most ``counters`` rows, none of the frequent ones missing."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = misra_gries((b.column(0).to_pylist() for b in batches), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"]
        )

    parts = digests.select("digest").mapInArrow(summarise, "digest binary, n long")
    # Merging summaries: add the counters, keep the largest. A value over the bound survives in both steps.
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def mark_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (hex)."""
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    hashed = with_digest(narrow, "digest").select("id", "digest", F.monotonically_increasing_id().alias("row"))
    hashed = materialize(hashed, "digests")
    total = hashed.count()

    def per_digest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("group_size"))

    candidates = materialize(frequent(hashed, counters), "candidates")
    winners = per_digest(hashed.join(F.broadcast(candidates), "digest", "left_semi"))
    winners = materialize(winners.where(F.col("group_size") * counters > total), "winners")
    heavy = hashed.join(F.broadcast(winners), "digest")
    others = hashed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = others.join(per_digest(others), "digest")
    return heavy.unionByName(light).select(
        F.col("id").alias(id_column),
        F.col("last.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns."""
    digest, own_id, own_digest = (free_name(docs, c) for c in ("digest", "stays_id", "stays_digest"))
    stay = mark_copies(docs, id_column, text_column, counters).where("kept")
    stay = stay.select(F.col(id_column).alias(own_id), F.unhex("text_sha256").alias(own_digest))
    here = with_digest(docs, digest, text_column).alias("d")
    same = F.col(f"d.{digest}").eqNullSafe(F.col(own_digest)) & F.col(f"d.{id_column}").eqNullSafe(F.col(own_id))
    return here.join(stay, same, "left_semi").dropDuplicates([digest, id_column]).drop(digest)
