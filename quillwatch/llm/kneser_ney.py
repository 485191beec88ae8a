"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Tokens are runs of letters and digits, each other run of non-blanks on its own, with case kept.
Trusted documents are those labelled of good quality and not toxic. By a hash of the id, half of
them are for counting and half for thresholds. All documents of the first half are counted, over
their whole texts. The triples of tokens go, packed in blocks, to shards of their middle token, where all
n-grams that follow or end with it are counted; a second shuffle adds up what shards share. A text's log
probability is a sum over its n-grams, each of which adds what it changes of its shorter ones' part. So blocks
of texts send the shards the triples that a bitmap of fixed size does not rule out, packed, and get back
sums per text; nobody holds the whole model. All documents are scored, over their whole texts, equal texts alike.

``fit`` brings a model to the driver instead, for fits that are small or that ``max_docs`` and
``max_tokens`` bound: the first of the counting half in the order of the hash, as far as they go.

A document's score is its cross entropy in nats per token, drawn towards the mean of the trusted
documents of its language by ``prior`` tokens, as short texts say little; perplexity is its
exponential. The threshold of a language is the ``quantile`` of the scores of the trusted documents in
the second half that have it (of all trusted documents, where that half has none), times ``slack``.
Languages without any, and documents with null language, take the threshold over all languages;
without any trusted documents everything is kept.

Null and empty texts have no tokens, perplexity null, and stay. Rows are scored each on its own, so
repeated rows agree; a label row per id is expected, of several the worst counts. Empty tables give
empty results. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwatch.llm.tables import free_name, map_batches
from quillwatch.llm.text import mix, text_rows
from quillwatch.session import fresh_path, materialize, scratch, write

QUANTILE = 0.99
SLACK = 1.25
PRIOR = 20
ORDERS = 3
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_START = 1  # what stands before a text
_GROUP = 1 << 17  # tokens scored together
_NONE, _STOP = 0, 2  # an n-gram that the model lacks; what stands behind a text
_BLOCK = 1 << 18  # tokens that ask for their n-grams together, and are counted together
_SHARD = 1 << 19  # tokens counted in a shard, about
_SHARDS = 24  # at least
_COMMON = 1 << 18  # tokens that are written by number, at most
_SLOTS = 27  # leading bits of an n-gram that the bitmap knows
_PIECE_BITS = 21  # of the bitmap in a row
_ID_SLOTS = 25  # leading bits of an id's hash that their bitmap knows


class Numbers(dict):
    """64-bit numbers of tokens, remembered."""

    def __missing__(self, token: str) -> int:
        self[token] = number = xxhash.xxh3_64_intdigest(token)
        return number


_NUMBERS, _REMEMBERED = Numbers(), 1 << 17


def tokens_of(text: bytes) -> np.ndarray:
    """64-bit token numbers."""
    if len(_NUMBERS) > _REMEMBERED:
        _NUMBERS.clear()
    return np.array(array("Q", map(_NUMBERS.__getitem__, _TOKEN.findall(text.decode("utf-8", "replace")))), dtype=np.uint64)


def gram(*tokens: np.ndarray) -> np.ndarray:
    """Number of an n-gram, from its last token to its first."""
    out = tokens[0]
    for back, token in enumerate(tokens[1:], 1):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + token + np.uint64(back))
    return out


def all_grams(texts: list[np.ndarray]) -> dict[str, np.ndarray]:
    """For every token of the texts in turn: its 1-, 2- and 3-gram and the contexts of the latter two."""
    start = np.full(ORDERS - 1, _START, dtype=np.uint64)
    flat = np.concatenate([x for t in texts for x in (start, t)])
    real = np.ones(len(flat), dtype=bool)
    begins = np.cumsum([0] + [len(t) + ORDERS - 1 for t in texts])[:-1]
    for k in range(ORDERS - 1):
        real[begins + k] = False
    at = np.flatnonzero(real)
    here, before, earlier = flat[at], flat[at - 1], flat[at - 2]
    return {"g1": here, "g2": gram(here, before), "g3": gram(here, before, earlier), "c2": before, "c3": gram(before, earlier)}


class Table:
    """Numbers to values, in shards by leading bits; a look-up goes to the few entries with the same leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, kind: type = np.float32) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(kind)
        bits = max(1, len(keys)).bit_length()
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.append(np.searchsorted(self.keys, edges), len(keys)).astype(np.int32)

    def get(self, keys: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which of the keys are there."""
        shard = (keys >> self.shift).astype(np.int64)
        at, end = self.first[shard], self.first[shard + 1]
        values, there = np.full(len(keys), default, dtype=self.values.dtype), np.zeros(len(keys), dtype=bool)
        open_ = np.flatnonzero(at < end)
        at, end = at[open_], end[open_]
        while len(open_):
            hit = self.keys[at] == keys[open_]
            values[open_[hit]], there[open_[hit]] = self.values[at[hit]], True
            at = at + 1
            go = ~hit & (at < end)
            open_, at, end = open_[go], at[go], end[go]
        return values, there


@dataclass
class Model:
    """Log probabilities of n-grams by order, log back-off weights of contexts, log probability of the unknown."""

    logp: dict[int, Table]
    backoff: dict[int, Table]
    unknown: float

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log probability of every token of the texts in turn."""
        if not sum(map(len, texts)):
            return np.zeros(0, dtype=np.float32)
        g = all_grams(texts)
        total, open_ = np.zeros(len(g["g1"]), dtype=np.float32), np.arange(len(g["g1"]))
        for order in range(ORDERS, 0, -1):
            default = self.unknown if order == 1 else 0.0
            logp, there = self.logp[order].get(g[f"g{order}"][open_], default)
            total[open_] += logp
            if order == 1:
                break
            open_ = open_[~there]
            total[open_] += self.backoff[order].get(g[f"c{order}"][open_], 0.0)[0]
        return total


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more, from how many n-grams have counts 1 to 4."""
    if not n[0] or not n[1]:
        return [0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def place_of():
    """Hash of the id that tells the halves and orders within them."""
    return F.xxhash64(F.lit(5), "doc_id")


def trusted_half(labels: DataFrame, half: int) -> DataFrame:
    """Ids of trusted documents in one half: 0 for counting, 1 for thresholds."""
    ids = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    place = place_of()
    return ids.where("quality = 1 and toxic = 0 and doc_id is not null").where(F.pmod(place, F.lit(2)) == half).select("doc_id", place.alias("place"))


@dataclass
class Tables:
    """The whole model: (order, gram, logp) and, for contexts, (order, gram, backoff); log probability of the unknown."""

    rows: DataFrame
    unknown: float


def fit_tables(docs: DataFrame, labels: DataFrame, max_docs: int | None = None, max_tokens: int | None = None,
               id_column: str = "doc_id", text_column: str = "text") -> Tables:
    """Model of all trusted documents in the first half, or of the first of them within the bounds."""
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    ids = materialize(trusted_half(labels, 0), "trusted")
    if max_docs is None and max_tokens is None:
        chosen = narrow.join(ids, "doc_id", "left_semi")
    else:
        chosen = narrow.join(ids, "doc_id").orderBy("place", "doc_id", F.length("text"), "text")
        if max_docs is not None:
            first = narrow.select("doc_id").join(ids, "doc_id").distinct().orderBy("place", "doc_id").limit(max_docs)
            chosen = chosen.join(first.select("doc_id"), "doc_id", "left_semi").orderBy("place", "doc_id", F.length("text"), "text").limit(max_docs)
        chosen = chosen.coalesce(1)  # the bounds hold for one sequence

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = max_tokens
        for batch in batches:
            for _, texts in text_rows(batch, "text", 64):
                some = []
                for text in texts:
                    tokens = tokens_of(text)
                    if left is not None:
                        tokens = tokens[: max(0, left)]
                        left -= len(tokens)
                    some.append(tokens)
                if sum(map(len, some)):
                    g = all_grams(some)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in g.values()], names=list(g))

    every = chosen.select("text").mapInArrow(rows, "g1 long, g2 long, g3 long, c2 long, c3 long")
    counts = {3: materialize(every.groupBy("g3", "c3", "g2", "c2", "g1").agg(F.count("*").alias("n")), "trigrams")}
    # Lower orders count in how many contexts a gram continues.
    counts[2] = materialize(counts[3].groupBy("g2", "c2", "g1").agg(F.count("*").alias("n")), "bigrams")
    counts[1] = materialize(counts[2].groupBy("g1").agg(F.count("*").alias("n")).withColumn("c1", F.lit(0)), "unigrams")
    probabilities, parts, unknown = None, [], float(np.log(1e-9))
    none = F.lit(None).cast("double")
    for order in (1, 2, 3):
        table = counts[order]
        n = table.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)], F.count("*"), F.sum("n")).first()
        d = discounts(list(n[:4]))
        taken = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        contexts = table.groupBy(f"c{order}").agg(F.sum("n").alias("total"), F.sum(taken).alias("taken"))
        contexts = contexts.withColumn("backoff", F.col("taken") / F.col("total"))
        own = table.join(contexts, f"c{order}").withColumn("own", (F.col("n") - taken) / F.col("total"))
        if order == 1:
            floor = contexts.select("backoff").first()
            floor = floor[0] / (n[4] + 1) if floor else 1e-9
            unknown = float(np.log(floor))
            p = own.select("g1", (F.col("own") + floor).alias("p"))
        else:
            p = own.join(probabilities, f"g{order - 1}").select(f"g{order}", (F.col("own") + F.col("backoff") * F.col("p")).alias("p"))
            contexts = materialize(contexts.select(F.col(f"c{order}").alias("gram"), "backoff"), "contexts")
            parts.append(contexts.select(F.lit(order - 1).alias("order"), "gram", none.alias("logp"), F.log("backoff").alias("backoff")))
        probabilities = materialize(p, "probabilities")
        parts.append(probabilities.select(F.lit(order).alias("order"), F.col(f"g{order}").alias("gram"), F.log("p").alias("logp"), none.alias("backoff")))
    return Tables(reduce(DataFrame.unionByName, parts), unknown)


def model_of(found: pa.Table, unknown: float) -> Model:
    """A model of these rows (order, gram, logp, backoff)."""
    order, gram, logp, backoff = (found.column(c).to_numpy() for c in ("order", "gram", "logp", "backoff"))
    gram, of = gram.view(np.uint64), lambda values, k: (order == k) & ~np.isnan(values)
    tables = {k: Table(gram[of(logp, k)], logp[of(logp, k)]) for k in range(1, ORDERS + 1)}
    return Model(tables, {k + 1: Table(gram[of(backoff, k)], backoff[of(backoff, k)]) for k in range(1, ORDERS)}, unknown)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int | None = None, max_tokens: int | None = None,
        id_column: str = "doc_id", text_column: str = "text") -> Model:
    """The model on the driver, for fits that are small or bounded."""
    tables = fit_tables(docs, labels, max_docs, max_tokens, id_column, text_column)
    return model_of(tables.rows.toArrow(), tables.unknown)


def losses(model: Model, texts: list[bytes]) -> tuple[list[int], list[float]]:
    """Per text the number of tokens and the sum of their negative log probabilities."""
    counts, sums_, some = [], [], []
    for i, text in enumerate(texts):
        some.append(tokens_of(text))
        if i == len(texts) - 1 or sum(map(len, some)) > _GROUP:
            sizes = np.array([len(t) for t in some])
            sums = np.append(0.0, np.cumsum(model.scores(some), dtype=np.float64))
            ends = np.cumsum(sizes)
            counts += sizes.tolist()
            sums_ += (sums[ends - sizes] - sums[ends]).tolist()
            some = []
    return counts, sums_


def _loss_columns(model: Model, batch: pa.RecordBatch | pa.Table, text_column: str) -> list[pa.Array]:
    counts, sums = [], []
    for _, texts in text_rows(batch, text_column, 128):
        for all_, some in zip((counts, sums), losses(model, texts)):
            all_ += some
    return [pa.array(counts, pa.int64()), pa.array(sums, pa.float64())]


def _loss_types(names: tuple[str, str]) -> list[T.StructField]:
    return [T.StructField(names[0], T.LongType()), T.StructField(names[1], T.DoubleType())]


def with_loss(docs: DataFrame, model: Model, text_column: str = "text", names: tuple[str, str] = ("n_tokens", "loss")) -> DataFrame:
    """docs with the number of tokens and the sum of their negative log probabilities."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_batches(docs, lambda batch: _loss_columns(held.value, batch, text_column), T.StructType(_loss_types(names)))


@dataclass
class Shards:
    """Where a token triple (first, middle, last) is counted: a shard of its middle token. So a shard holds all n-grams that
    follow or end with that token. Tokens that are very frequent have several shards, dealt out by the first token."""

    shards: int
    hot: np.ndarray  # frequent tokens, ascending
    parts: np.ndarray  # and in how many shards each of them is
    common: np.ndarray  # tokens that are written by their place in this list, ascending

    def found(self, tokens: np.ndarray) -> np.ndarray:
        """Places of tokens in ``hot``; -1 for others."""
        if not len(self.hot):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.hot, tokens), len(self.hot) - 1)
        return np.where(self.hot[at] == tokens, at, -1)

    def of(self, first: np.ndarray, middle: np.ndarray) -> np.ndarray:
        at, out = self.found(middle), middle.view(np.int64) % self.shards
        some = np.flatnonzero(at >= 0)
        out[some] += (mix(mix(first[some])) % self.parts[at[some]].astype(np.uint64)).astype(np.int64)
        return out % self.shards


def squeezed(values: np.ndarray) -> bytes:
    """An array in few bytes: the narrowest type, compressed."""
    if values.dtype not in (np.float32, np.uint64):
        values = values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)
    data = values.tobytes()
    return values.dtype.char.encode() + len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[1:9], "little")
    return np.frombuffer(pa.decompress(data[9:], decompressed_size=size, codec="zstd", asbytes=True), dtype=data[:1].decode())


def squeezed_words(words: np.ndarray, common: np.ndarray) -> bytes:
    """Ascending tokens, those of a list of common ones by their place there."""
    at = np.minimum(np.searchsorted(common, words), max(len(common) - 1, 0))
    there = common[at] == words if len(common) else np.zeros(len(words), dtype=bool)
    places = squeezed(np.diff(at[there], prepend=0))
    return len(places).to_bytes(4, "little") + places + squeezed(words[~there])


def unsqueezed_words(data: bytes, common: np.ndarray) -> np.ndarray:
    size = 4 + int.from_bytes(data[:4], "little")
    places, rest = np.cumsum(unsqueezed(data[4:size]), dtype=np.int64), unsqueezed(data[size:])
    return np.sort(np.append(common[places], rest)) if len(places) else rest


_PACKED = "kind int, shard int, block long, words binary, first binary, middle binary, last binary, n binary, docs binary"
_COUNT, _ASK, _DOCS = range(3)
_ARROW = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("words", "first", "middle", "last", "n", "docs"))])


def packed(first: np.ndarray, middle: np.ndarray, last: np.ndarray, shards: Shards, docs: np.ndarray | None, block: int) -> Iterator[dict]:
    """A row per shard: its different triples in order as numbers of its own words, how often each occurs, and in which documents."""
    words = reduce(np.union1d, (first, middle, last))
    bits = len(words).bit_length()
    first, middle, last = (np.searchsorted(words, x) for x in (first, middle, last))
    keys = (middle << (2 * bits)) | (last << bits) | first
    if docs is None:
        keys, n = np.unique(keys, return_counts=True)
    else:
        order = np.argsort(keys, kind="stable")
        docs, (keys, at, n) = docs[order], np.unique(keys[order], return_index=True, return_counts=True)
    mask = (1 << bits) - 1
    middle, last, first = keys >> (2 * bits), (keys >> bits) & mask, keys & mask
    shard = shards.of(words[first], words[middle])
    order = np.argsort(shard, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        if not len(own):
            continue
        held = np.zeros(len(words) + 1, dtype=np.int64)
        for x in (middle, last, first):
            held[x[own] + 1] = 1
        numbers = np.cumsum(held)[:-1]
        m = numbers[middle[own]]
        row = {"kind": _COUNT if docs is None else _ASK, "shard": int(shard[own[0]]), "block": block, "words": squeezed_words(words[held[1:] > 0], shards.common),
               "first": squeezed(numbers[first[own]]), "middle": squeezed(np.diff(m, prepend=0)), "last": squeezed(numbers[last[own]]), "n": squeezed(n[own]), "docs": None}
        if docs is not None:
            ends = np.cumsum(n[own])
            row["docs"] = squeezed(docs[np.repeat(at[own] - ends + n[own], n[own]) + np.arange(ends[-1])])
        yield row


def unpacked(row: dict, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First, middle and last tokens of a row's triples, and how often each occurs."""
    words = unsqueezed_words(row["words"], common)
    first, last = (words[unsqueezed(row[c])] for c in ("first", "last"))
    return first, words[np.cumsum(unsqueezed(row["middle"]), dtype=np.int64)], last, unsqueezed(row["n"]).astype(np.int64)


def triples(texts: list[np.ndarray], end: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First, middle and last token and the text's place, for every token as the last one, and for what stands behind a text."""
    start, stop = np.full(ORDERS - 1, _START, dtype=np.uint64), np.array([_STOP] if end else [], dtype=np.uint64)
    flat = np.concatenate([x for t in texts for x in (start, t, stop)])
    sizes = np.array([len(t) + len(stop) for t in texts])
    at = np.arange(len(flat) - 2 * len(texts)) + np.repeat(2 * np.arange(1, len(texts) + 1), sizes)
    return flat[at - 2], flat[at - 1], flat[at], np.repeat(np.arange(len(texts)), sizes)


def text_groups(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[tuple[list[bytes], list[np.ndarray]]]:
    """Texts and their tokens, about ``most`` tokens at a time or a longer text."""
    texts, tokens, size = [], [], 0
    for batch in batches:
        for _, some in text_rows(batch, column, 64):
            for text in some:
                texts.append(text)
                tokens.append(tokens_of(text))
                size += len(tokens[-1]) + 1
                if size >= most:
                    yield texts, tokens
                    texts, tokens, size = [], [], 0
    if texts:
        yield texts, tokens


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def counted(chosen: DataFrame, shards: Shards) -> DataFrame:
    """The triples of all these texts, packed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens in text_groups(batches, "text", _BLOCK):
            first, middle, last, _ = triples(tokens, end=False)
            for at in range(0, len(first), _BLOCK):
                piece = slice(at, at + _BLOCK)
                yield batch_of([*packed(first[piece], middle[piece], last[piece], shards, None, 0)])

    return chosen.select("text").mapInArrow(rows, _PACKED)


def merged(rows: pa.Table, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different triples of all counting rows, by middle, last and first token, with their counts."""
    parts = [unpacked(row, common) for batch in rows.to_batches() for row in batch.to_pylist() if row["kind"] == _COUNT]
    if not parts:
        none = np.zeros(0, dtype=np.uint64)
        return none, none, none, np.zeros(0, dtype=np.int64)
    columns = [list(c) for c in zip(*parts)]
    del parts
    for k, some in enumerate(columns):
        columns[k] = np.concatenate(some)
    order = np.lexsort(columns[0:3:2] + columns[1:2])
    for k in range(4):
        columns[k] = columns[k][order]
    first, middle, last, n = columns
    new = np.flatnonzero(np.append(True, (np.diff(first) != 0) | (np.diff(last) != 0) | (np.diff(middle) != 0)))
    return first[new], middle[new], last[new], np.add.reduceat(n, new)


def pairs_of(middle: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair of sorted triples begins, and how many first tokens it has."""
    new = np.flatnonzero(np.append(True, (np.diff(last) != 0) | (np.diff(middle) != 0))[: len(middle)])
    return new, np.diff(np.append(new, len(middle)))


_STATS = "kind int, shard int, a long, b long, n long, bits binary"
_NOFN, _UNIGRAM, _HOT, _BITS = range(4)


def statistics(shards: Shards, slots: int):
    """Of a shard: how many n-grams have counts 1 to 4, after how many tokens each token stands, pairs of frequent tokens,
    and which leading bits its tokens and pairs have."""

    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        _, middle, last, n = merged(rows, shards.common)
        new, counts = pairs_of(middle, last)
        v, w = middle[new], last[new]
        hot = shards.found(v) >= 0
        out = []
        for order, some in ((3, n), (2, counts[~hot])):
            out.append((_NOFN, np.full(4, order), np.arange(1, 5), np.bincount(np.minimum(some, 5), minlength=6)[1:5]))
        tokens, after = np.unique(w[~hot], return_counts=True)
        out.append((_UNIGRAM, tokens.view(np.int64), np.zeros(len(tokens), dtype=np.int64), after))
        out.append((_HOT, v[hot].view(np.int64), w[hot].view(np.int64), counts[hot]))
        columns = [np.concatenate([np.full(len(x[3]), x[0]) for x in out]), *(np.concatenate([x[k] for x in out]) for k in (1, 2, 3))]
        size = len(columns[0])
        numbers = pa.Table.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(np.full(size, shard), pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:]), pa.nulls(size, pa.binary())], names=["kind", "shard", "a", "b", "n", "bits"])
        slot = np.unique(np.concatenate([v, w, gram(w, v)]) >> np.uint64(64 - slots)).astype(np.int64)
        piece = slot >> _PIECE_BITS
        pieces = [p for p in np.split(slot, np.flatnonzero(np.diff(piece)) + 1) if len(p)]
        bits = [{"kind": _BITS, "shard": shard, "a": int(p[0] >> _PIECE_BITS), "b": 0, "n": 0, "bits": squeezed(np.diff(p & ((1 << _PIECE_BITS) - 1), prepend=0))} for p in pieces]
        return pa.concat_tables([numbers, pa.Table.from_pylist(bits, schema=numbers.schema)])

    return run


def bitmap(pieces: DataFrame, slots: int) -> np.ndarray:
    """One bit for every value of the leading bits: whether a token or pair has them. Merged in Spark, a row per piece comes here."""

    def union(rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _PIECE_BITS, dtype=bool)
        for data in rows.column("bits"):
            bits[np.cumsum(unsqueezed(data.as_py()), dtype=np.int64)] = True
        return pa.table({"a": rows.column("a").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(1 << (slots - 3), dtype=np.uint8)
    size = 1 << (_PIECE_BITS - 3)
    for row in pieces.select("a", "bits").groupBy("a").applyInArrow(union, "a long, bits binary").toArrow().to_pylist():
        out[row["a"] * size : (row["a"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def in_bitmap(bits: np.ndarray, grams: np.ndarray, slots: int) -> np.ndarray:
    slot = grams >> np.uint64(64 - slots)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


@dataclass
class Constants:
    """Discounts by order; of all tokens their total, the share of the unknown, and what frequent tokens have in all their shards:
    after how many tokens they stand, how many pairs they begin, and of those with counts 1, 2 and 3 or more."""

    discounts: dict[int, list[float]]
    total: int
    floor: float
    hot: np.ndarray

    def taken(self, order: int, n: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.discounts[order]])[np.minimum(n, 3)]

    def unigram(self, n: np.ndarray) -> np.ndarray:
        return (n - self.taken(1, n)) / max(self.total, 1) + self.floor


def weights(rows: pa.Table, side: pa.Table, shards: Shards, c: Constants) -> dict[str, Table]:
    """What each n-gram of a shard adds to the log probability of a text beyond what its shorter ones do: a seen n-gram takes
    back the back-off, so a text's log probability is a sum over all its n-grams that are seen."""
    first, middle, last, n = merged(rows, shards.common)
    kind = side.column("kind").to_numpy()
    a, b = (side.column(x).to_numpy().view(np.uint64) for x in ("a", "b"))
    count, after = (side.column(x).to_numpy() for x in ("n", "after"))
    token, frequent_pair = kind == _UNIGRAM, kind == _HOT
    stands = Table(a[token], after[token], np.float64)
    new, counts = pairs_of(middle, last)
    cold = new[shards.found(middle[new]) < 0]
    v, w = np.append(middle[cold], a[frequent_pair]), np.append(last[cold], b[frequent_pair])
    count = np.append(counts[shards.found(middle[new]) < 0], count[frequent_pair])
    p1 = c.unigram(np.append(stands.get(last[cold], 0)[0].astype(np.int64), after[frequent_pair]))
    heads, at = np.unique(v, return_inverse=True)
    taken2 = c.taken(2, count)
    total, taken = np.bincount(at, count, len(heads)), np.bincount(at, taken2, len(heads))
    hot = shards.found(heads)
    some = hot >= 0
    total[some], taken[some] = c.hot[hot[some], 1], c.hot[hot[some], 2:] @ np.array(c.discounts[2])
    back2 = taken / total
    p2 = (count - taken2) / total[at] + back2[at] * p1
    pair = Table(gram(w, v), p2, np.float64)
    contexts, of = np.unique(gram(middle, first), return_inverse=True)
    total3, taken3 = np.bincount(of, n, len(contexts)), c.taken(3, n)
    back3 = np.bincount(of, taken3, len(contexts)) / total3
    low = pair.get(gram(last, middle), 0)[0]
    p3 = (n - taken3) / total3[of] + back3[of] * low
    stood = c.hot[:, 0] > 0
    words, stood = np.append(a[token], shards.hot[stood]), np.append(after[token], c.hot[stood, 0])
    return {
        "token": Table(heads, np.log(back2), np.float64),
        "stand": Table(words, np.log(c.unigram(stood)) - np.log(c.floor), np.float64),
        "pair": Table(gram(w, v), np.log(p2) - np.log(back2[at]) - np.log(p1), np.float64),
        "context": Table(contexts, np.log(back3), np.float64),
        "triple": Table(gram(last, middle, first), np.log(p3) - np.log(back3[of]) - np.log(low), np.float64),
    }


def chosen_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with one of these ids. A bitmap of fixed size spares most other texts the shuffle of the join."""
    slot = f"shiftrightunsigned(place, {64 - _ID_SLOTS})"
    pieces = ids.groupBy(F.expr(f"{slot} >> 6").alias("at")).agg(F.expr(f"bit_or(shiftleft(1L, cast({slot} & 63 as int)))").alias("bits")).toArrow()
    bits = np.zeros(1 << (_ID_SLOTS - 6), dtype=np.int64)
    bits[pieces.column("at").to_numpy()] = pieces.column("bits").to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    @F.arrow_udf("boolean")
    def may_be(place: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(held.value, place.to_numpy(zero_copy_only=False).view(np.uint64), _ID_SLOTS))

    return docs.where(may_be(place_of())).join(ids, "doc_id", "left_semi")


def frequent(chosen: DataFrame) -> Shards:
    """Shards for these texts, from the tokens of one in 16 ids. They decide where things are counted, not what is."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in text_groups(batches, "text", _BLOCK):
            values, n = np.unique(triples(some, end=False)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], names=["token", "n"])

    some = chosen.where(F.pmod(F.shiftright(place_of(), 8), F.lit(16)) == 0)
    counts = materialize(some.select("text").mapInArrow(tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "frequent", drop_shuffles=True)
    total = counts.agg(F.sum("n")).first()[0] or 0
    shards = max(_SHARDS, 16 * total // _SHARD)
    hot = counts.where(F.col("n") * 2 * shards > total).toArrow()
    keys, n = hot.column("token").to_numpy().view(np.uint64), hot.column("n").to_numpy()
    order = np.argsort(keys)
    return Shards(int(shards), keys[order], np.ceil(n[order] * shards / max(total, 1)).astype(np.int64), most_common(counts, "token", "n"))


def most_common(counts: DataFrame, token: str, n: str) -> np.ndarray:
    some = counts.orderBy(F.desc(n), token).limit(_COMMON).select(token).toArrow().column(token)
    return np.sort(some.to_numpy().view(np.uint64))


def fit_shards(stats: DataFrame, shards: Shards) -> tuple[DataFrame, Constants, np.ndarray]:
    """Counts that go to the shards: (shard, kind, a, b, n, after), the constants of the model, and the tokens most common in it."""
    spark = stats.sparkSession
    hot = spark.createDataFrame([(int(t), int(p)) for t, p in zip(shards.hot.view(np.int64), shards.parts)], "a long, parts long")
    pairs = materialize(stats.where(F.col("kind") == _HOT).groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs", drop_shuffles=True)
    unigrams = stats.where(F.col("kind") == _UNIGRAM).select("shard", "a", "n")
    stands = unigrams.select("a", "n").unionByName(pairs.select(F.col("b").alias("a"), F.lit(1).cast("long").alias("n")))
    stands = materialize(stands.groupBy("a").agg(F.sum("n").alias("after")), "stands", drop_shuffles=True)
    counts = {k: [0, 0, 0, 0] for k in (1, 2, 3)}
    sums = stats.where(F.col("kind") == _NOFN).groupBy("a", "b").agg(F.sum("n")).collect()
    sums += [(2, *r) for r in pairs.where("n <= 4").groupBy("n").count().collect()]
    sums += [(1, *r) for r in stands.where("after <= 4").groupBy("after").count().collect()]
    for order, k, n in sums:
        counts[order][k - 1] += n
    by_order = {k: discounts(n) for k, n in counts.items()}
    words, total = stands.agg(F.count("*"), F.sum("after")).first()
    total = total or 0
    taken = sum(d * n for d, n in zip(by_order[1], (*counts[1][:2], words - sum(counts[1][:2]))))
    floor = taken / total / (words + 1) if total else 1e-9
    classes = [F.count(F.when(c, 1)) for c in (F.col("n") == 1, F.col("n") == 2, F.col("n") > 2)]
    of = pairs.groupBy("a").agg(F.sum("n").alias("total"), *[c.alias(f"k{i}") for i, c in enumerate(classes)]).join(stands, "a", "left")
    own = {r.a: (r.after or 0, r.total, r.k0, r.k1, r.k2) for r in of.collect()}
    table = np.array([own.get(int(t), (0, 0, 0, 0, 0)) for t in shards.hot.view(np.int64)], dtype=np.int64).reshape(-1, 5)
    place = F.pmod(F.col("a"), F.lit(shards.shards))
    places = unigrams.select("shard", "a").unionByName(stands.select(place.cast("int").alias("shard"), "a")).distinct()
    none = F.lit(0).cast("long")
    side = places.join(stands, "a").select("shard", F.lit(_UNIGRAM).alias("kind"), "a", none.alias("b"), none.alias("n"), "after")
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    dealt = pairs.join(F.broadcast(hot), "a").join(stands.withColumnRenamed("a", "b"), "b").withColumn("part", spread)
    dealt = dealt.select(F.pmod(place + F.col("part"), F.lit(shards.shards)).cast("int").alias("shard"), F.lit(_HOT).alias("kind"), "a", "b", "n", "after")
    return side.unionByName(dealt.distinct()), Constants(by_order, total, floor, table), most_common(stands, "a", "after")


def text_digest(column: str):
    """What stands for a text: equal texts have equal losses. Null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(column).cast("binary"), F.lit("").cast("binary"))))


def asked(docs: DataFrame, shards: Shards, bits: np.ndarray) -> DataFrame:
    """The triples of all texts as far as the model may know them, packed, and a row per block with its texts."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row = TaskContext.get().partitionId() << 40, TaskContext.get().partitionId() << 40
        known = lambda grams: in_bitmap(held.value, grams, _SLOTS)
        for texts, tokens in text_groups(batches, "text", _BLOCK):
            digests = np.frombuffer(b"".join(hashlib.md5(t).digest() for t in texts), dtype=np.uint64)
            every = triples(tokens, end=True)
            for at in range(0, len(every[0]), _BLOCK):
                first, middle, last, docs_ = (x[at : at + _BLOCK] for x in every)
                low, high = int(docs_[0]), int(docs_[-1]) + 1
                stop, docs_ = last == _STOP, docs_ - low
                n = np.bincount(docs_[~stop], minlength=high - low)
                out = [{"kind": _DOCS, "shard": block % shards.shards, "block": block, "words": squeezed(digests[2 * low : 2 * high]), "n": squeezed(n), "docs": squeezed(row + np.arange(low, high))}]
                there = known(middle) & ~(stop & (middle == _START))
                first, middle, last, docs_, stop = (x[there] for x in (first, middle, last, docs_, stop))
                if len(first):
                    first = np.where(~stop & ((middle == _START) | known(gram(middle, first))), first, np.uint64(_NONE))
                    last = np.where(stop | known(gram(last, middle)), last, np.uint64(_NONE))
                    out += packed(first, middle, last, shards, docs_, block)
                yield batch_of(out)
                block += 1
            row += len(texts)

    return docs.select("text").mapInArrow(rows, _PACKED)


def text_losses(docs: DataFrame, labels: DataFrame, max_docs: int | None = None, max_tokens: int | None = None,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per different text: digest, number of tokens and the sum of their negative log probabilities under the whole model. Written."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    path = fresh_path(spark, "losses")
    with scratch(spark):
        if max_docs is None and max_tokens is None:
            found = sharded_losses(docs, labels)
        else:
            found = with_loss(docs.select(text_digest("text").alias("digest"), "text"), fit(docs, labels, max_docs, max_tokens))
        found = found.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"), F.min("loss").alias("loss"))
        write(found, path)
    return spark.read.schema(found.schema).parquet(path)


def sharded_losses(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (digest, n_tokens, loss) for all texts."""
    chosen = chosen_of(docs, materialize(trusted_half(labels, 0), "trusted"))
    shards = frequent(chosen)
    counts = counted(chosen, shards)
    stats = materialize(counts.groupBy("shard").applyInArrow(statistics(shards, _SLOTS), _STATS), "statistics", drop_shuffles=True)
    side, constants, common = fit_shards(stats, shards)
    bits = bitmap(stats.where(F.col("kind") == _BITS), _SLOTS)
    asking = replace(shards, common=common)
    rows = counts.unionByName(asked(docs, asking, bits))

    def answer(rows: pa.Table, side: pa.Table) -> pa.Table:
        w, out = weights(rows, side, shards, constants), []
        for batch in rows.to_batches(max_chunksize=1):
            row = batch.to_pylist()[0]
            if row["kind"] == _DOCS:
                out.append({"block": row["block"], "shard": -1, "words": row["words"], "n": row["n"], "docs": row["docs"]})
            elif row["kind"] == _ASK:
                first, middle, last, n = unpacked(row, common)
                more = sum(w[k].get(g, 0.0)[0] for k, g in (
                    ("token", middle), ("pair", gram(last, middle)), ("context", gram(middle, first)), ("triple", gram(last, middle, first))))
                values = w["stand"].get(middle, 0.0)[0] + np.where(last == _STOP, 0.0, more)
                sums = np.bincount(unsqueezed(row["docs"]), np.repeat(values, n))
                out.append({"block": row["block"], "shard": row["shard"], "words": None, "n": squeezed(sums.astype(np.float32)), "docs": None})
        return pa.Table.from_pylist(out, schema=_ANSWER)

    def add(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["shard"])
        n = unsqueezed(rows[0]["n"])
        loss = n * -float(np.log(constants.floor))
        for row in rows[1:]:
            sums = unsqueezed(row["n"])
            loss[: len(sums)] -= sums
        digests = unsqueezed(rows[0]["words"]).tobytes()
        return pa.table([pa.array(unsqueezed(rows[0]["docs"]).astype(np.int64)), pa.array([digests[i : i + 16] for i in range(0, len(digests), 16)], pa.binary()), pa.array(n.astype(np.int64)), pa.array(loss)], names=["row", "digest", "n_tokens", "loss"])

    answers = rows.groupBy("shard").cogroup(side.groupBy("shard")).applyInArrow(answer, "block long, shard int, words binary, n binary, docs binary")
    by_row = answers.groupBy("block").applyInArrow(add, "row long, digest binary, n_tokens long, loss double")
    # A text longer than a block has a row in several.
    return by_row.groupBy("row").agg(F.first("digest").alias("digest"), F.sum("n_tokens").alias("n_tokens"), F.sum("loss").alias("loss"))


_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("n", pa.binary()), ("docs", pa.binary())])


@dataclass
class Thresholds:
    """Per language: mean loss per token of trusted documents, and the largest score that is kept."""

    table: DataFrame  # lang (null: all languages), mean, threshold

    def judge(self, scored: DataFrame, prior: int, lang_column: str, names: tuple[str, ...]) -> DataFrame:
        """scored (with n_tokens and loss under names[:2]) with perplexity, threshold and kept."""
        n_tokens, loss, perplexity, threshold, kept = names
        every = self.table.where("lang is null").select("mean", "threshold").first() or (None, None)
        limits = [free_name(scored, c) for c in ("own_lang", "own_mean", "own_threshold")]
        own = self.table.where("lang is not null").select(*[F.col(c).alias(n) for c, n in zip(("lang", "mean", "threshold"), limits)])
        joined = scored.alias("s").join(own, F.col(f"s.{lang_column}") == F.col(limits[0]), "left")
        mean, most = (F.coalesce(c, F.lit(e).cast("double")) for c, e in zip(limits[1:], every))
        value = score_of(F.col(f"s.{n_tokens}"), F.col(f"s.{loss}"), mean, prior)
        return joined.select("s.*", F.exp(value).alias(perplexity), F.exp(most).alias(threshold), F.coalesce(value <= most, F.lit(True)).alias(kept))


def score_of(n_tokens, loss, mean, prior: int):
    return F.when(n_tokens > 0, (loss + prior * mean) / (n_tokens + prior))


def thresholds(scored: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, prior: int = PRIOR) -> Thresholds:
    """From (doc_id, lang, n_tokens, loss) of all documents."""
    good = scored.where("n_tokens > 0")
    held_out = good.join(trusted_half(labels, 1).drop("place"), "doc_id", "left_semi")
    fitted = good.join(trusted_half(labels, 0).drop("place"), "doc_id", "left_semi")
    some = materialize(held_out.withColumn("half", F.lit(1)).unionByName(fitted.withColumn("half", F.lit(0))), "calibration")
    # Every document counts for its language and for all languages; a group without held-out documents takes the fitted ones.
    some = some.withColumn("lang", F.explode(F.array_distinct(F.array("lang", F.lit(None).cast("string")))))
    means = some.groupBy("lang", "half").agg((F.sum("loss") / F.sum("n_tokens")).alias("mean"))
    best = means.groupBy("lang").agg(F.max(F.struct("half", "mean")).alias("best")).select(F.col("lang").alias("l"), "best.*")
    valued = some.alias("s").join(best.alias("b"), F.col("s.lang").eqNullSafe(F.col("b.l")) & (F.col("s.half") == F.col("b.half")))
    value = score_of(F.col("n_tokens"), F.col("loss"), F.col("mean"), prior)
    most = valued.groupBy("s.lang").agg(F.first("mean").alias("mean"), (F.percentile_approx(value, quantile, 10_000) + float(np.log(slack))).alias("threshold"))
    return Thresholds(materialize(most, "thresholds"))


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
             quantile: float = QUANTILE, slack: float = SLACK, prior: int = PRIOR, max_docs: int | None = None, max_tokens: int | None = None) -> DataFrame:
    """One row per document: doc_id, lang, n_tokens, loss, perplexity, threshold, kept."""
    losses_ = text_losses(docs, labels, max_docs, max_tokens, id_column, text_column)
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(lang_column).alias("lang"), text_digest(text_column).alias("digest"))
    scored = materialize(narrow.join(losses_, "digest").drop("digest"), "scored", drop_shuffles=True)
    return thresholds(scored, labels, quantile, slack, prior).judge(scored, prior, "lang", ("n_tokens", "loss", "perplexity", "threshold", "kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
              quantile: float = QUANTILE, slack: float = SLACK, prior: int = PRIOR, max_docs: int | None = None, max_tokens: int | None = None) -> DataFrame:
    """The documents that are kept, with their columns."""
    losses_ = text_losses(docs, labels, max_docs, max_tokens, id_column, text_column)
    names = tuple(free_name(docs, c) for c in ("n_tokens", "loss", "perplexity", "threshold", "kept"))
    digest = free_name(docs, "digest")
    of_text = losses_.select(F.col("digest").alias(digest), F.col("n_tokens").alias(names[0]), F.col("loss").alias(names[1]))
    columns = [F.col(c).alias(n) for c, n in zip((id_column, lang_column), ("doc_id", "lang"))]
    narrow = docs.select(*columns, text_digest(text_column).alias("digest")).join(losses_, "digest").drop("digest")
    limits = thresholds(narrow, labels, quantile, slack, prior)
    scored = docs.withColumn(digest, text_digest(text_column)).join(of_text, digest)
    return limits.judge(scored, prior, lang_column, names).where(F.col(names[-1])).select(*docs.columns)
