"""Byte-level BPE by dynamic programming over prefixes, and decoding.

Joining pairs of bytes by rank gives every string one encoding, and the encoding of a string begins
with those of its shorter prefixes as far as they end at a token. So each prefix of a piece has one
valid last token: the token t that ends there and is ``compatible`` with the last token s of the
prefix in front of it, which means that joining the bytes of s and t gives back s and t. ``Prefixes``
keeps this token for every prefix. Bytes appended to a piece leave all earlier entries as they are.
After an edit, entries are computed anew from the edit on, until as many as the longest token has
bytes agree with the old ones: what follows is then the old table. ``reencode`` does the same for
texts, where pieces (matches of the splitting pattern) far from the edit keep their ids.

Vocabularies are files of ranks, one token in base64 and its rank to a line, with all 256 bytes among
the tokens. The driver reads the file and broadcasts it: some 50,000 lines, one megabyte. Nothing else leaves the
task that holds a text; there is no shuffle. A worker remembers the ids of about ``REMEMBERED`` words and pieces and as
many pairs of tokens; a table that is full is emptied and begun anew. What is not remembered is encoded in the order of
its bytes, so that a piece goes on in the table of the piece before it, from where they differ.

A null text counts as empty, has no ids and decodes to nothing. Ids, repeated rows, ties and extra
columns do not matter: each row is encoded for itself. An added column replaces one of the same name.
An empty table gives an empty result. A text is taken in runs of about a megabyte of words, and ids are
decoded 65,536 at a time, so a very long text needs little more memory than its ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillwatch.llm.tables import map_batches

REMEMBERED = 1 << 19
_RUN = 1 << 20
_DECODED = 1 << 16
NEVER = 1 << 62
#: No match of a splitting pattern depends on more than so many characters behind its end.
LOOKAHEAD = 3


class _Remember(dict):
    """Values of a function of one argument, begun anew when there are too many."""

    def __init__(self, function: Callable, most: int = REMEMBERED):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # A few vocabularies hold tokens that joining never reaches; they stand for a whole piece only.
        self.reached = {t: r for t, r in ranks.items() if len(t) == 1 or self.joined(t) == [r]}
        # By the last three bytes of a prefix, or the last two: the lengths that a token ending there may have.
        tails: dict[bytes, set[int]] = {}
        for token in self.reached:
            tails.setdefault(token[-3:], set()).add(len(token))
        for tail in [t for t in tails if len(t) == 3]:
            tails[tail] |= tails.get(tail[-2:], set())
        self.lengths = {tail: (*sorted(lengths - {1}, reverse=True), 1) for tail, lengths in tails.items() if len(tail) > 1}
        self.ends = _Remember(lambda token: self._edges(token, -1))
        self.beginnings = _Remember(lambda token: self._edges(token, 0))
        self.compatible = _Remember(self._compatible)

    def _joins(self, data: bytes) -> Iterator[tuple[list[bytes], int]]:
        """The parts of data and the rank that is joined next (``NEVER`` at the end): the leftmost of the pairs with the
        lowest rank becomes one part, again and again."""
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [self.ranks.get(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while pairs and (lowest := min(pairs)) != NEVER:
            yield parts, lowest
            at = pairs.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = self.ranks.get(parts[at - 1] + parts[at], NEVER)
            if at < len(pairs):
                pairs[at] = self.ranks.get(parts[at] + parts[at + 1], NEVER)
        yield parts, NEVER

    def joined(self, data: bytes) -> list[int]:
        """Ids of data by joining pairs."""
        *_, (parts, _) = self._joins(data)
        return [self.ranks[p] for p in parts]

    def _edges(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts that stand at one side of a token while its bytes are joined, each with the rank
        that makes it (0 for a byte) and the rank that makes it a part of the next."""
        found: list[tuple[bytes, int, int]] = []
        for parts, rank in self._joins(self.tokens[token]):
            if not found or len(parts[side]) > len(found[-1][0]):
                found.append((parts[side], found[-1][2] if found else 0, rank))
            else:
                found[-1] = (*found[-1][:2], rank)
        return found

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Do the bytes of both, joined together, give both again? They do unless, at some moment, the part left of
        the border and the one right of it make a token of a rank below those that are next on either side. Ranks
        only rise while a string is joined, since a token is made of tokens of lower rank."""
        for left, made, gone in self.ends[pair[0]]:
            for right, made_too, gone_too in self.beginnings[pair[1]]:
                rank = self.ranks.get(left + right)
                if rank is not None:
                    at = max(rank, made, made_too)
                    if at < gone and at <= gone_too:
                        return False
        return True

    def blobs(self, shown: Callable[[int, bytes], bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``shown`` says of each token, one after the other, with starts and lengths by id."""
        parts = [shown(i, self.tokens[i]) if i in self.tokens else b"" for i in range(max(self.tokens) + 1)]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


class Prefixes:
    """A piece of text with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, to: int, done: Callable[[int], bool] | None = None) -> None:
        """The valid last tokens of the prefixes up to ``to`` bytes, or until ``done`` says so."""
        v, data, last = self.vocabulary, self.data, self.last
        reached, compatible, lengths = v.reached, v.compatible, v.lengths
        for end in range(len(last), to + 1):
            tail = data[end - 3 : end] if end > 2 else data[:end]
            for length in lengths.get(tail) or lengths.get(tail[-2:], (1,)):
                start = end - length
                if start < 0:
                    continue
                token = reached.get(data[start:end])
                if token is not None and (not start or compatible[last[start], token]):
                    last.append(token)
                    break
            if done and done(end):
                break

    def append(self, data: bytes) -> None:
        self.data += data
        self._fill(len(self.data))

    def become(self, data: bytes) -> None:
        """The same for another piece; entries of the beginning that both share stay."""
        shared = 0
        for a, b in zip(self.data, data):
            if a != b:
                break
            shared += 1
        del self.last[shared + 1 :]
        self.data = data
        self._fill(len(data))

    def edit(self, start: int, end: int, data: bytes) -> int:
        """Put data in place of bytes start to end; returns how many entries were computed."""
        old, shift, agree = self.last, len(data) - (end - start), 0
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[: start + 1]

        def met(at: int) -> bool:
            nonlocal agree
            agree = agree + 1 if at > start + len(data) and old[at - shift] == self.last[at] else 0
            return agree >= self.vocabulary.longest

        self._fill(len(self.data), met)
        at = len(self.last) - 1
        self.last += old[at - shift + 1 :]
        return at - start

    def ids(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end])
            end -= len(self.vocabulary.tokens[self.last[end]])
        return found[::-1]


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[0] : starts[0] + sizes[0]], then the next, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class _Ids:
    """Ids of strings that were met before."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.sizes, self.starts, self.flat = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int32))

    def add(self, keys: Iterable[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        self.index.update(zip(keys, range(len(self.index), len(self.index) + len(sizes))))
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, keys: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each key, and all their ids."""
        places = np.fromiter(map(self.index.__getitem__, keys), dtype=np.int64)
        return self.sizes[places], _gather(self.flat, self.starts[places], self.sizes[places])


class Codec:
    """Encodes and decodes texts by one vocabulary and splitting pattern.

    The pattern has to cut at white space as the usual ones do: a match holds white space only at
    its beginning, or nothing else. White space and what follows it up to the next white space, a word here, is then
    encoded alike wherever it stands."""

    _WORDS = regex.compile(r"\s+\S*|\S+")
    _BORDER = regex.compile(r"(?<=\S)\s")
    _LONG_SPACE = regex.compile(r"\s ")

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.pieces, self.words = _Ids(), _Ids()  # words without the one space in front
        self._bytes = vocabulary.blobs(lambda i, token: token)
        self._decimal = vocabulary.blobs(lambda i, token: b" %d" % i)

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Ids of pieces, in their order: each goes on where it differs from the one before."""
        table, sizes, flat, order = Prefixes(self.vocabulary), [], [], sorted(pieces)
        for piece in order:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            if whole is None:
                table.become(data)
            ids = [whole] if whole is not None else table.ids()
            sizes.append(len(ids))
            flat += ids
        self.pieces.add(order, np.array(sizes, dtype=np.int64), np.array(flat, dtype=np.int32))

    def _learn(self, words: set[str], before: str, known: _Ids) -> None:
        if len(self.pieces.index) > REMEMBERED:
            self.pieces = _Ids()
        cut = [self.pattern.findall(before + word) for word in words]
        self._learn_pieces(set(chain.from_iterable(cut)) - self.pieces.index.keys())
        sizes, flat = self.pieces.of(chain.from_iterable(cut))
        reach = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum([0] + [len(pieces) for pieces in cut])
        known.add(words, np.diff(reach[ends]), flat)

    def _runs(self, text: str) -> Iterator[str]:
        """The text in runs of about a megabyte that end where a word does."""
        at = 0
        while at < len(text):
            found = self._BORDER.search(text, at + _RUN) if len(text) - at > 2 * _RUN else None
            to = found.start() if found else len(text)
            yield text[at:to]
            at = to

    def _encode_runs(self, runs: list[str]) -> list[np.ndarray]:
        """Ids of each run. What is not remembered is learnt for all of them at once."""
        spaced: list[list[str]] = []
        others: list[list[str]] = []
        for run in runs:
            if self._LONG_SPACE.search(run):
                spaced.append([])
                others.append(self._WORDS.findall(run))
            else:
                first, *rest = run.split(" ")
                spaced.append(rest)
                others.append([first] if first else [])
        if len(self.words.index) > REMEMBERED:
            self.words = _Ids()
        both = []
        for words, before, known in ((others, "", _Ids()), (spaced, " ", self.words)):
            self._learn(set(chain.from_iterable(words)) - known.index.keys(), before, known)
            sizes, ids = known.of(chain.from_iterable(words))
            reach = np.concatenate([[0], np.cumsum(sizes)])
            ends = reach[np.cumsum([len(w) for w in words], dtype=np.int64)]
            both.append(np.split(ids, ends[:-1]) if runs else [])
        return [np.concatenate(pair) for pair in zip(*both)]

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text; texts are taken together up to about a megabyte."""
        held: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > _RUN and held:
                yield from self._encode_runs(held)
                held, size = [], 0
            if len(text) > _RUN:
                yield np.concatenate([i for run in self._runs(text) for i in self._encode_runs([run])])
            else:
                held.append(text)
                size += len(text)
        yield from self._encode_runs(held)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    @staticmethod
    def _spelled(blobs, ids: np.ndarray) -> Iterator[bytes]:
        blob, starts, sizes = blobs
        for at in range(0, len(ids), _DECODED):
            some = ids[at : at + _DECODED]
            yield _gather(blob, starts[some], sizes[some]).tobytes()

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of the tokens, some thousands of tokens at a time."""
        return self._spelled(self._bytes, ids)

    def decimal(self, ids: np.ndarray) -> Iterator[bytes]:
        """The ids as decimal numbers, each after a space."""
        return self._spelled(self._decimal, ids)

    def reencode(self, text: str, ids: np.ndarray, start: int, end: int, inserted: str) -> tuple[str, np.ndarray]:
        """Text and ids after putting ``inserted`` in place of the characters start to end. Words that end well before
        the edit keep their ids, and so do those behind it from the first old word border on."""
        changed = text[:start] + inserted + text[end:]
        words = [(m.start(), m.end()) for m in self._WORDS.finditer(text)]
        kept = sum(e + LOOKAHEAD <= start for _, e in words)
        begin = words[kept][0] if kept < len(words) else (words[-1][1] if words else 0)
        # A border in front of white space stays one if the character before it is not edited.
        after = next((s for s, _ in words if s > end), len(text))
        bytes_before, bytes_after = len(text[:begin].encode()), len(text[after:].encode())
        reach = np.concatenate([[0], np.cumsum(self._bytes[2][ids])])
        head = int(np.searchsorted(reach, bytes_before))
        tail = int(np.searchsorted(reach, reach[-1] - bytes_after))
        middle = self.encode(changed[begin : after + len(changed) - len(text)])
        return changed, np.concatenate([ids[:head], middle, ids[tail:]]).astype(np.int32)


_CODECS: dict[tuple[str, str], Codec] = {}


class Coder:
    """What tasks get: the vocabulary file as a broadcast value, and the pattern. Workers build the codec once."""

    def __init__(self, spark: SparkSession, vocabulary_path: str, pattern: str):
        with open(vocabulary_path, "rb") as file:
            data = file.read()
        self.key = (hashlib.sha256(data).hexdigest(), pattern)
        self.file = spark.sparkContext.broadcast(data)

    def codec(self) -> Codec:
        if self.key not in _CODECS:
            _CODECS[self.key] = Codec(Vocabulary(read_ranks(self.file.value)), self.key[1])
        return _CODECS[self.key]


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    return (value.as_py() or "" for value in batch.column(column))


def encode(docs: DataFrame, coder: Coder, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """docs with the ids of the text as an array."""

    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = coder.codec()
        found = list(codec.encode_all(_texts(batch, text_column)))
        ends = np.cumsum([0] + [len(f) for f in found])
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))]

    return map_batches(docs, ids, T.StructType([T.StructField(ids_column, T.ArrayType(T.IntegerType(), True))]))


def decode(encoded: DataFrame, coder: Coder, ids_column: str = "ids", bytes_column: str = "decoded") -> DataFrame:
    """encoded with the bytes that the ids stand for. Null ids stand for none."""

    def decoded(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = coder.codec()
        rows = (v.values for v in batch.column(ids_column))
        return [pa.array([b"".join(codec.decode(r.to_numpy())) if r is not None else b"" for r in rows], pa.binary())]

    return map_batches(encoded, decoded, T.StructType([T.StructField(bytes_column, T.BinaryType())]))


def reencode(encoded: DataFrame, coder: Coder, start: str, end: str, inserted: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """encoded, with an edit applied to each row's text and ids: the columns ``start``, ``end`` (characters, end not
    included) and ``inserted`` name it. A null among them leaves the row as it is; places are moved into the text."""
    order = encoded.columns

    def edited(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = coder.codec()
        texts, found = [], []
        columns = (batch.column(c).to_pylist() for c in (text_column, ids_column, start, end, inserted))
        for text, ids, at, to, put in zip(*columns):
            if text is not None and None not in (at, to, put):
                at = min(max(at, 0), len(text))
                text, changed = codec.reencode(text, np.array(ids or [], dtype=np.int32), at, min(max(to, at), len(text)), put)
                ids = changed.tolist()
            texts.append(text)
            found.append(ids)
        return [pa.array(texts, pa.string()), pa.array(found, pa.list_(pa.int32()))]

    added = T.StructType([T.StructField(text_column, T.StringType()), T.StructField(ids_column, T.ArrayType(T.IntegerType(), True))])
    return map_batches(encoded, edited, added).select(*order)


def round_trip(docs: DataFrame, coder: Coder, text_column: str = "text") -> DataFrame:
    """docs with the number of tokens, the digest of the ids in decimal, and the digest of the bytes they decode to."""

    def digests(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = coder.codec()
        rows = []
        for ids in codec.encode_all(_texts(batch, text_column)):
            numbers, decoded = hashlib.sha256(), hashlib.sha256()
            for at, some in enumerate(codec.decimal(ids)):
                numbers.update(some if at else some[1:])
            for some in codec.decode(ids):
                decoded.update(some)
            rows.append((len(ids), numbers.hexdigest(), decoded.hexdigest()))
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]

    added = T.StructType([
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])
    return map_batches(docs, digests, added)
