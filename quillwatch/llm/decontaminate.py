"""Benchmark decontamination: test n-grams in a broadcast hash set, found in training token windows.

Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased. A window is
``n`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.
Hashes of all windows of a document are looked up in the set, and every hit is verified word by word.

The set is broadcast in blocks of about ``block_windows`` windows, so its size is bounded however
large the benchmark is; documents pass once for each block and are written between two blocks, and
no document is shuffled.

Null texts have no words and nothing hits them. Repeated documents are judged each on its own;
repeated items count once; an item with a null id is named by the empty string. Empty tables give
empty or untouched results. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwatch.llm.tables import free_name, map_batches
from quillwatch.llm.text import ALPHANUMERIC, hashed_words, inside, text_rows, windows
from quillwatch.session import materialize

WINDOW = 10
BLOCK_WINDOWS = 250_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_BITS = 22


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def item_windows(benchmark: DataFrame, n: int, id_column: str, text_column: str) -> DataFrame:
    """(item, words, length, hash) of every window, once each."""
    rows = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_rows(batch, "text", 64):
                items = batch.column("item").slice(at, len(texts)).to_pylist()
                for item, text in zip(items, texts):
                    words = words_of(text)
                    k = min(n, len(words))
                    found = sorted({b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}) if k else []
                    hashes = [int(windows(next(hashed_words([w], ALPHANUMERIC))[1], k)[0]) for w in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.string()), pa.array(found, pa.binary()),
                         pa.array([k] * len(found), pa.int32()), pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))],
                        names=["item", "words", "length", "hash"],
                    )

    return rows.mapInArrow(run, "item string, words binary, length int, hash long").distinct()


class WindowSet:
    """Windows of one block: per length, sorted hashes and what stands behind each."""

    def __init__(self, rows: list) -> None:
        by_length: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for item, words, length, hashed in rows:
            by_length.setdefault(length, {}).setdefault(hashed & (2**64 - 1), {}).setdefault(bytes(words), []).append(item)
        self.lengths = {}
        for length, known in by_length.items():
            hashes = np.array(sorted(known), dtype=np.uint64)
            bitmap = np.zeros(1 << _BITS, dtype=bool)
            bitmap[hashes >> np.uint64(64 - _BITS)] = True
            self.lengths[length] = hashes, bitmap, known

    def candidates(self, words: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, dict]]:
        """(position, length, texts behind the hash) wherever a window's hash is in the set."""
        for length, (hashes, bitmap, known) in self.lengths.items():
            found = windows(words, length)
            maybe = np.flatnonzero(bitmap[found >> np.uint64(64 - _BITS)] & inside(begins, len(words), length))
            place = np.minimum(np.searchsorted(hashes, found[maybe]), len(hashes) - 1)
            for at in maybe[hashes[place] == found[maybe]]:
                yield int(at), length, known[int(found[at])]


def find_hits(texts: list[bytes], known: WindowSet) -> Iterator[tuple[int, int, list[tuple[int, int]], set[str]]]:
    """Per text: its index, number of words, verified hits as (first word, end), items."""
    for first, words, begins in hashed_words(texts, ALPHANUMERIC):
        hits: dict[int, list[tuple[int, int, dict]]] = {}
        for at, length, behind in known.candidates(words, begins):
            doc = int(np.searchsorted(begins, at, side="right")) - 1
            hits.setdefault(doc, []).append((at - int(begins[doc]), length, behind))
        for doc in range(len(begins) - 1):
            spans, items = [], set()
            if doc in hits:
                own = words_of(texts[first + doc])
                for at, length, behind in hits[doc]:
                    if found := behind.get(b" ".join(own[at : at + length])):
                        spans.append((at, at + length))
                        items.update(found)
            yield first + doc, int(begins[doc + 1] - begins[doc]), spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def scan_names(docs: DataFrame) -> tuple[str, str, str]:
    return tuple(free_name(docs, c) for c in ("n_words", "spans", "items"))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text_column: str = "text", item_column: str = "item_id",
         item_text: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs with n_words, spans (hit words as merged ranges from start to before end) and items (sorted ids, as strings)."""
    names = scan_names(docs)
    known = materialize(item_windows(benchmark, n, item_column, item_text), "windows")
    blocks = max(1, -(-known.count() // block_windows))
    block = F.pmod(F.xxhash64("hash", "item"), F.lit(blocks))
    added = T.StructType([T.StructField(names[0], T.LongType()), T.StructField(names[1], _SPAN), T.StructField(names[2], T.ArrayType(T.StringType()))])
    for k in range(blocks):
        rows = [tuple(r) for r in known.where(block == k).collect()]
        held = docs.sparkSession.sparkContext.broadcast(WindowSet(rows))
        if k:
            docs = materialize(docs, "scanned")
        docs = _with_block(docs, held, text_column, names, again=k > 0)
    return docs


def _with_block(docs: DataFrame, held, text_column: str, names: tuple[str, str, str], again: bool) -> DataFrame:
    """docs with the hits of one block, added to those of earlier blocks."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def search(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, spans, items = [], [], []
        before = [batch.column(c).to_pylist() for c in names[1:]] if again else None
        for at, texts in text_rows(batch, text_column):
            for i, n_words, hits, found in find_hits(texts, held.value):
                if before:
                    hits = hits + [(s["start"], s["end"]) for s in before[0][at + i]]
                    found = found | set(before[1][at + i])
                counts.append(n_words)
                spans.append([{"start": s, "end": e} for s, e in merged(hits)])
                items.append(sorted(found))
        return [pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))]

    added = [T.StructField(names[0], T.LongType()), T.StructField(names[1], _SPAN), T.StructField(names[2], T.ArrayType(T.StringType()))]
    return map_batches(docs, search, T.StructType(added))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """docs without the hit words: a span goes from its first word's first to its last word's last byte."""
    names = scan_names(docs)

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        out: list[bytes | None] = []
        spans = batch.column(names[1]).to_pylist()
        for at, texts in text_rows(batch, text_column):
            for i, text in enumerate(texts):
                if spans[at + i]:
                    places = [m.span() for m in _WORD.finditer(text)]
                    pieces, to = [], 0
                    for s in spans[at + i]:
                        pieces.append(text[to : places[s["start"]][0]])
                        to = places[s["end"] - 1][1]
                    text = b"".join([*pieces, text[to:]])
                out.append(text)
        values = pa.array(out, pa.binary()).cast(pa.string())
        nulls = batch.column(text_column).is_null()
        return [pc.if_else(nulls, pa.scalar(None, pa.string()), values)]

    found = scan(docs, benchmark, text_column=text_column, **options)
    cleaned = free_name(found, "cleaned")
    found = map_batches(found, cut, T.StructType([T.StructField(cleaned, T.StringType())]))
    return found.select(*[F.col(cleaned).alias(c) if c == text_column else F.col(c) for c in docs.columns])


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns."""
    spans = scan_names(docs)[1]
    return scan(docs, benchmark, **options).where(F.size(spans) == 0).select(*docs.columns)
