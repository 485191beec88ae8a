"""Words and their hashes, for code that runs inside tasks on batches of whole texts.

Texts are UTF-8 bytes. All the word definitions used here cut at ASCII bytes only, so they can be
applied to bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Separators of the contracts: space and the control characters 0x09 to 0x0D.
BLANKS = b" \t\n\x0b\x0c\r"
_PIECE = 1 << 20  # bytes of text hashed at once
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _alphabet(separators: Iterable[int], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: is it part of a word, and the number it counts as."""
    word = np.ones(256, dtype=bool)
    word[list(separators)] = False
    codes = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        codes[65:91] = codes[97:123]
    return word, codes


#: Runs of non-blanks, as they stand; the same with A-Z lower-cased; runs of letters and digits, lower-cased.
PLAIN = _alphabet(BLANKS, lower=False)
FOLDED = _alphabet(BLANKS, lower=True)
ALPHANUMERIC = _alphabet([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        factors[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(factors)
    return have[:n]


def _rolling(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values times powers; the hash of [s, e) is (sums[e] - sums[s]) * base**-s."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    return sums


def _hash_bytes(data: bytes, alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in data."""
    is_word, codes = alphabet
    raw = np.frombuffer(data, dtype=np.uint8)
    flags = np.zeros(len(raw) + 2, dtype=np.int8)
    flags[1:-1] = is_word[raw]
    steps = np.diff(flags)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    sums = _rolling(codes[raw], _BASE)
    back = _powers(_INVERSE, len(raw) + 1)
    return starts, ends, mix((sums[ends] - sums[starts]) * back[starts])


def _pieces(data: bytes, alphabet) -> Iterator[bytes]:
    """A long text in pieces that end at a separator, where there is one."""
    is_word, at = alphabet[0], 0
    while len(data) - at > 2 * _PIECE:
        to = at + _PIECE
        while to < len(data) and is_word[data[to]]:
            to += 1
        yield data[at:to]
        at = to
    yield data[at:]


def hashed_words(texts: list[bytes], alphabet) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of consecutive texts: index of the first, hashes of all their words, and where each
    text's words begin in that list (with the end as last entry). A group holds about a megabyte,
    or a single longer text."""
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first])
        while last < len(texts) and size + len(texts[last]) <= _PIECE:
            size += len(texts[last]) + 1
            last += 1
        if last == first + 1 and size > 2 * _PIECE:
            words = np.concatenate([_hash_bytes(p, alphabet)[2] for p in _pieces(texts[first], alphabet)])
            yield first, words, np.array([0, len(words)])
        else:
            group = texts[first:last]
            starts, _, words = _hash_bytes(b"\n".join(group), alphabet)
            begins = np.cumsum([0] + [len(t) + 1 for t in group])
            yield first, words, np.searchsorted(starts, begins)
        first = last


def windows(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash for every run of k consecutive entries of words, across text borders as well."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = (_BASE * (2 * seed + 1) ** 5) % (1 << 64)
    values = mix(words + np.uint64(seed)) if seed else words
    sums = _rolling(values, base)
    return mix((sums[k:] - sums[:n]) * _powers(pow(base, -1, 1 << 64), n))


def inside(begins: np.ndarray, total: int, k: int) -> np.ndarray:
    """Of the total - k + 1 windows of k entries: which of them stay inside one text."""
    n = total - k + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    room = np.repeat(begins[1:], np.diff(begins))[:n]
    return np.arange(n) + k <= room


def text_rows(batch: pa.RecordBatch, column: str, step: int = 512) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch as bytes, a few hundred at a time; null counts as empty."""
    values = batch.column(column).cast(pa.binary() if not pa.types.is_large_string(batch.schema.field(column).type) else pa.large_binary())
    for at in range(0, len(values), step):
        yield at, [t or b"" for t in values.slice(at, step).to_pylist()]
