"""Language-model scoring by masked pseudo-likelihood.

A token is a word, A-Z lower-cased. The ``FREQUENT`` most common words of the whole corpus have a
number of their own, all others share ``SHARED`` numbers by hash. A small network predicts the number
at a position from ``SIDE`` tokens on either side: embeddings, one hidden layer, softmax. The probability
of a token is that of its number given its neighbours times the word's share of the number's occurrences
in the corpus (a factored softmax), so every word has a probability of its own, and those of all words
add up to one. A document's score is the sum of their logarithms over all its tokens.

Words are counted over all documents. The shares of the most common words, ``FAMILIAR`` at most, are
broadcast; the counts of all others are joined with the words of each document. A word that the counted
documents do not hold scores like one that they hold once. Texts are then read once more and written as numbers, one byte a token; all
rounds of training, and the scores of the corpus itself, read these. Training is in numpy inside the tasks: every document of the
corpus gives all its positions as targets, each in one of the rounds by a seeded draw. Tasks train on their own
documents from common parameters, and the parameters are averaged in Spark, weighted by targets. Only
averages reach the driver. Recomputing a lost task gives the same parameters again.

Null and empty texts have no tokens and score 0. Rows are scored each on its own. An empty table
gives an empty result. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwatch.llm.tables import free_name, map_batches
from quillwatch.llm.text import FOLDED, hashed_words, mix, text_rows
from quillwatch.session import materialize

FREQUENT, SHARED = 192, 64
FAMILIAR = 1 << 18  # words whose counts the tasks hold; the counts of all others are joined
SIDE, WIDTH, HIDDEN = 2, 16, 32
ROUNDS, RATE, BATCH = 3, 0.1, 512
_VOCABULARY = FREQUENT + SHARED
_EDGE = _VOCABULARY  # stands before and after a text
_BLOCK = 1024
_ROWS = 512
_SHAPES = {
    "embedding": (_VOCABULARY + 1, WIDTH), "inner": (2 * SIDE * WIDTH, HIDDEN), "inner_bias": (HIDDEN,),
    "outer": (HIDDEN, _VOCABULARY), "outer_bias": (_VOCABULARY,),
}
_SIZES = [int(np.prod(s)) for s in _SHAPES.values()]


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    return {n: x.reshape(s) for (n, s), x in zip(_SHAPES.items(), np.split(flat.astype(np.float32), np.cumsum(_SIZES)[:-1]))}


def pack(network: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([network[n].ravel() for n in _SHAPES]).astype(np.float64)


def word_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(word, n) over all documents, words by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_rows(batch, text_column):
                for _, words, _ in hashed_words(texts, FOLDED):
                    kinds, n = np.unique(words, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    counted = docs.select(text_column).mapInArrow(run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    def __init__(self, words: list[int]) -> None:
        known = np.array(words, dtype=np.int64).view(np.uint64)
        order = np.argsort(known)
        self.words, self.numbers = known[order], order.astype(np.int32)
        self.share([], [], {})

    def share(self, familiar: np.ndarray, counts: np.ndarray, totals: dict[int, int]) -> None:
        """Take the counts of some words, and of all words of each number."""
        known = np.array(familiar, dtype=np.int64).view(np.uint64)
        order = np.argsort(known)
        self.familiar, self.logs = known[order], np.log(np.array(counts, dtype=np.float64))[order]
        self.totals = np.zeros(_VOCABULARY)
        for number, n in totals.items():
            self.totals[number] = np.log(n)
        self.totals[:FREQUENT] = 0

    def numbers_of(self, words: np.ndarray) -> np.ndarray:
        numbers = (FREQUENT + (mix(words) % np.uint64(SHARED))).astype(np.int32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[at] == words
            numbers[known] = self.numbers[at[known]]
        return numbers

    def shares_of(self, words: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log share that each word has in its number, and which words lack the log of their count in it."""
        out, rare = -self.totals[numbers], numbers >= FREQUENT
        some = np.flatnonzero(rare)
        if len(self.familiar):
            at = np.minimum(np.searchsorted(self.familiar, words[some]), len(self.familiar) - 1)
            known = self.familiar[at] == words[some]
            out[some[known]] += self.logs[at[known]]
            rare[some[known]] = False
        return out, rare


@dataclass
class Words:
    """The vocabulary for the tasks, and the counts (word, n) of all words."""

    shared: Broadcast
    counts: DataFrame

    @property
    def value(self) -> Vocabulary:
        return self.shared.value


def neighbours(numbers: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Per token the numbers of SIDE tokens on either side, with the edge outside its text."""
    sizes = np.diff(begins)
    left = np.arange(len(numbers)) - np.repeat(begins[:-1], sizes)
    right = np.repeat(sizes, sizes) - 1 - left
    padded = np.concatenate([np.full(SIDE, _EDGE, dtype=np.int32), numbers, np.full(SIDE, _EDGE, dtype=np.int32)])
    out = np.empty((len(numbers), 2 * SIDE), dtype=np.int32)
    for d in range(1, SIDE + 1):
        out[:, SIDE - d] = np.where(left >= d, padded[SIDE - d : SIDE - d + len(numbers)], _EDGE)
        out[:, SIDE + d - 1] = np.where(right >= d, padded[SIDE + d : SIDE + d + len(numbers)], _EDGE)
    return out


def neighbours_at(numbers: np.ndarray, begins: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The same for some positions only."""
    doc = np.searchsorted(begins, positions, side="right") - 1
    left, right = positions - begins[doc], begins[doc + 1] - 1 - positions
    out = np.empty((len(positions), 2 * SIDE), dtype=np.int32)
    for d in range(1, SIDE + 1):
        out[:, SIDE - d] = np.where(left >= d, numbers[np.maximum(positions - d, 0)], _EDGE)
        out[:, SIDE + d - 1] = np.where(right >= d, numbers[np.minimum(positions + d, len(numbers) - 1)], _EDGE)
    return out


def forward(network: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inputs = network["embedding"][around].reshape(len(around), -1)
    hidden = np.tanh(inputs @ network["inner"] + network["inner_bias"])
    # Hidden values and weights are bounded, so exponentials stay in range.
    return inputs, hidden, hidden @ network["outer"] + network["outer_bias"]


def log_probabilities(network: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray) -> np.ndarray:
    out = np.empty(len(targets), dtype=np.float32)
    for at in range(0, len(targets), _BLOCK):
        own = slice(at, at + _BLOCK)
        logits = forward(network, around[own])[2]
        chosen = logits[np.arange(len(logits)), targets[own]]
        np.exp(logits, out=logits)
        out[own] = chosen - np.log(logits.sum(1))
    return out


def _summed(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each place."""
    order = np.argsort(places.astype(np.uint16), kind="stable")
    in_order = places[order]
    starts = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1]))
    out = np.zeros((size, rows.shape[1]), dtype=rows.dtype)
    out[in_order[starts]] = np.add.reduceat(rows[order], starts)
    return out


def train_batch(network: dict[str, np.ndarray], squares: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray) -> None:
    """One step of Adagrad on the mean loss; changes network and squares."""
    inputs, hidden, logits = forward(network, around)
    np.exp(logits, out=logits)
    error = logits / logits.sum(1, keepdims=True)
    error[np.arange(len(targets)), targets] -= 1
    error /= len(targets)
    back = (error @ network["outer"].T) * (1 - hidden**2)
    embedding = _summed(around.ravel(), (back @ network["inner"].T).reshape(-1, WIDTH), len(network["embedding"]))
    steps = {"embedding": embedding, "inner": inputs.T @ back, "inner_bias": back.sum(0), "outer": hidden.T @ error, "outer_bias": error.sum(0)}
    for name, step in steps.items():
        squares[name] += step**2
        network[name] -= RATE * step / np.sqrt(squares[name] + 1e-6)
    np.clip(network["outer"], -2, 2, out=network["outer"])
    np.clip(network["outer_bias"], -20, 20, out=network["outer_bias"])


def begin(counts: list[int], total: int) -> np.ndarray:
    """Parameters before training: the output bias gives every number its share in the corpus."""
    draw = np.random.default_rng(11)
    network = {n: draw.normal(0, 0.1, s).astype(np.float32) for n, s in _SHAPES.items()}
    rest = max(1, total - sum(counts)) / SHARED
    shares = np.array([*counts, *[1] * (FREQUENT - len(counts)), *[rest] * SHARED], dtype=np.float64)
    network["outer_bias"] = np.log(shares / shares.sum()).clip(-20, 0).astype(np.float32)
    network["inner_bias"][:] = 0
    return pack(network)


def numbered(docs: DataFrame, words: Words, text_column: str = "text") -> tuple[DataFrame, tuple[str, ...]]:
    """docs with four columns, and their names: the numbers of the text's tokens, one byte each; the sum of the log shares
    of its words, without the logs of the counts of rare ones; the rare words; a number of the row, which a write fixes."""
    names = tuple(free_name(docs, c) for c in ("numbers", "share", "rare", "row"))
    shared = words.shared

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found: list[bytes] = []
        shares, rest, ends = [], [np.zeros(0, dtype=np.uint64)], [np.zeros(1, dtype=np.int64)]
        for _, texts in text_rows(batch, text_column):
            for _, own, begins in hashed_words(texts, FOLDED):
                numbers = shared.value.numbers_of(own)
                logs, rare = shared.value.shares_of(own, numbers)
                numbers = numbers.astype(np.uint8).tobytes()
                found += [numbers[a:b] for a, b in zip(begins[:-1], begins[1:])]
                sums = np.append(0.0, np.cumsum(logs))
                shares.append(sums[begins[1:]] - sums[begins[:-1]])
                ends.append(ends[-1][-1] + np.append(0, np.cumsum(rare))[begins[1:]])
                rest.append(own[rare])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(rest).view(np.int64)))
        return [pa.array(found, pa.binary()), pa.array(np.concatenate([np.zeros(0), *shares])), lists]

    types = (T.BinaryType(), T.DoubleType(), T.ArrayType(T.LongType()))
    added = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    return map_batches(docs, run, added).withColumn(names[3], F.monotonically_increasing_id()), names


def _number_rows(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of some hundred texts, one after the other, and where each begins."""
    values = batch.column(column)
    for at in range(0, len(values), _ROWS):
        some = values.slice(at, _ROWS).to_pylist()
        begins = np.cumsum([0] + [len(v) for v in some])
        yield np.frombuffer(b"".join(some), dtype=np.uint8).astype(np.int32), begins


def round_of(numbers: np.ndarray, begins: np.ndarray, rounds: int) -> np.ndarray:
    """In which round each position is a target; by its token and its place in the text only, so all rounds agree."""
    place = np.arange(len(numbers)) - np.repeat(begins[:-1], np.diff(begins))
    return (mix((place * (_VOCABULARY + 1) + numbers).astype(np.uint64)) % np.uint64(rounds)).astype(np.int64)


def train_task(texts: Iterator[tuple[np.ndarray, np.ndarray]], parameters: np.ndarray, number: int, rounds: int) -> tuple[np.ndarray, int]:
    """What one task learns in a round from its texts, given as numbers and begins: parameters, and number of targets."""
    network = unpack(parameters)
    squares = {n: np.full(s, 0.1, dtype=np.float32) for n, s in _SHAPES.items()}
    n, rest, held = 0, [], 0
    for numbers, begins in texts:
        chosen = np.flatnonzero(round_of(numbers, begins, rounds) == number)
        rest.append((neighbours_at(numbers, begins, chosen), numbers[chosen]))
        held += len(chosen)
        if held >= BATCH:
            around, targets = (np.concatenate(x) for x in zip(*rest))
            whole = held // BATCH * BATCH
            for at in range(0, whole, BATCH):
                train_batch(network, squares, around[at : at + BATCH], targets[at : at + BATCH])
            n, held, rest = n + whole, held - whole, [(around[whole:], targets[whole:])]
    if held:
        around, targets = (np.concatenate(x) for x in zip(*rest))
        train_batch(network, squares, around, targets)
    return pack(network), n + held


def train_round(numbers: DataFrame, parameters: np.ndarray, number: int, rounds: int, column: str = "numbers") -> np.ndarray:
    """Average of what the tasks learn from their own documents."""
    held = numbers.sparkSession.sparkContext.broadcast(parameters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (rows for batch in batches for rows in _number_rows(batch, column))
        flat, n = train_task(texts, held.value, number, rounds)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * n), pa.array(np.full(len(flat), n, dtype=np.int64))],
                names=["place", "value", "n"],
            )

    learned = numbers.select(column).mapInArrow(run, "place int, value double, n long")
    mean = learned.groupBy("place").agg((F.sum("value") / F.sum("n")).alias("value")).toArrow()
    out = parameters.copy()
    out[mean.column("place").to_numpy()] = mean.column("value").to_numpy()
    return out


def number_totals(counts: DataFrame, vocabulary: Vocabulary) -> dict[int, int]:
    """How many occurrences in the corpus each number has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(_VOCABULARY, dtype=np.int64)
        for batch in batches:
            words, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            np.add.at(totals, vocabulary.numbers_of(words.view(np.uint64)), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_VOCABULARY)), pa.array(totals)], names=["number", "n"])

    found = counts.select("word", "n").mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    return {r["number"]: r["n"] for r in found.where("n > 0").collect()}


def familiar_words(counts: DataFrame, most: int) -> DataFrame:
    """Words that are counted at least so often that there are no more than ``most`` of them."""
    step = F.floor(4 * F.log2("n"))
    sizes = sorted(((r["step"], r["words"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    kept = [at for at, total in zip((s for s, _ in sizes), np.cumsum([w for _, w in sizes])) if total <= most]
    return counts.where(step >= kept[-1]) if kept else counts.limit(0)


def vocabulary_of(docs: DataFrame, text_column: str = "text") -> tuple[Words, np.ndarray]:
    """The vocabulary, and the parameters before training."""
    counts = materialize(word_counts(docs, text_column), "word-counts")
    top = [tuple(r) for r in counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    total = counts.agg(F.sum("n")).first()[0] or 0
    vocabulary = Vocabulary([w for w, _ in top])
    familiar = familiar_words(counts, FAMILIAR).select("word", "n").toArrow()
    vocabulary.share(familiar.column(0).to_numpy(), familiar.column(1).to_numpy(), number_totals(counts, vocabulary))
    words = Words(docs.sparkSession.sparkContext.broadcast(vocabulary), counts)
    return words, begin([n for _, n in top], total)


def learn(numbers: DataFrame, parameters: np.ndarray, rounds: int = ROUNDS, column: str = "numbers"):
    """Parameters after all rounds over a written table of numbers, as a broadcast."""
    for number in range(rounds):
        parameters = train_round(numbers, parameters, number, rounds, column)
    return numbers.sparkSession.sparkContext.broadcast(parameters)


def train(docs: DataFrame, text_column: str = "text", rounds: int = ROUNDS):
    """Vocabulary and parameters, as broadcasts."""
    words, parameters = vocabulary_of(docs, text_column)
    rows, names = numbered(docs.select(text_column), words, text_column)
    return words, learn(materialize(rows.select(names[0]), "numbers"), parameters, rounds, names[0])


def score_names(docs: DataFrame) -> tuple[str, str]:
    return tuple(free_name(docs, c) for c in ("n_tokens", "log_likelihood"))


def score_numbers(rows: DataFrame, words: Words, parameters, names: tuple[str, ...]) -> DataFrame:
    """Written rows with n_tokens and log_likelihood, the sum of the conditional log probabilities, in place of what
    ``numbered`` added under these names."""
    numbers_column, share, rare, row = names

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        network, counts, sums = unpack(parameters.value), [], []
        for numbers, begins in _number_rows(batch, numbers_column):
            found = np.append(0.0, np.cumsum(log_probabilities(network, neighbours(numbers, begins), numbers), dtype=np.float64))
            counts += np.diff(begins).tolist()
            sums += (found[begins[1:]] - found[begins[:-1]]).tolist()
        return [pa.array(counts, pa.int64()), pa.array(sums, pa.float64())]

    n_tokens, likelihood = score_names(rows.drop(*names))
    added = T.StructType([T.StructField(n_tokens, T.LongType()), T.StructField(likelihood, T.DoubleType())])
    scored = materialize(map_batches(rows.drop(rare), run, added).drop(numbers_column), "scored")
    counts = rows.select(row, F.explode(rare).alias("word")).join(words.counts, "word").groupBy(row).agg(F.sum(F.log("n")).alias(rare))
    others = [c for c in rows.columns if c not in names]
    total = F.col(likelihood) + F.col(share) + F.coalesce(rare, F.lit(0.0))
    return scored.join(counts, row, "left").select(*others, n_tokens, total.alias(likelihood))


def score(docs: DataFrame, words: Words, parameters, text_column: str = "text") -> DataFrame:
    """docs with n_tokens and log_likelihood."""
    rows, names = numbered(docs, words, text_column)
    return score_numbers(materialize(rows, "numbers"), words, parameters, names)


def train_and_score(docs: DataFrame, text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """docs without their text, with n_tokens and log_likelihood under a network trained on all of them."""
    words, parameters = vocabulary_of(docs, text_column)
    rows, names = numbered(docs, words, text_column)
    rows = materialize(rows.drop(text_column), "numbers")
    return score_numbers(rows, words, learn(rows, parameters, rounds, names[0]), names)
