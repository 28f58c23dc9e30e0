"""Words, word hashes and shingles of whole texts, vectorised over Arrow batches.

Hashes are 64 bit: a prefix sum of byte codes times powers of an odd constant gives the hash of
any byte range with one subtraction, so every word of a batch is hashed in a few array passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

#: Bytes handled at once; bounds the arrays of eight bytes per input byte.
PIECE = 1 << 21
_U = np.uint64
_RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_RADIX, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finaliser of MurmurHash3, public domain)."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_PLACES = mix(np.arange(1, 257, dtype=_U)) | _U(1)


def apart(docs: DataFrame, keep: list[str]) -> list[Column]:
    """The columns `keep` under names c0, c1, ..., which no helper column can clash with."""
    return [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(keep)]


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, after A-Z are folded to a-z."""

    word: np.ndarray
    fold: np.ndarray
    code: np.ndarray


def _alphabet(word_bytes: list[int]) -> Alphabet:
    fold = np.arange(256, dtype=np.uint8)
    fold[ord("A") : ord("Z") + 1] += 32
    inside = np.zeros(256, bool)
    inside[word_bytes] = True
    return Alphabet(inside[fold], fold, _BYTE_CODES[fold])


#: Words are runs of anything but space, tab, line and page breaks.
SPACED = _alphabet([b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D])
#: Words are runs of ASCII letters and digits and of any character outside ASCII.
ALNUM = _alphabet([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the len + 1 offsets of its values; a null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    if data is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about PIECE bytes of text (one row at least), with `utf8` of each."""
    data, bounds = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1
        upto = min(max(upto, at + 1), batch.num_rows)
        yield (
            batch.slice(at, upto - at),
            data[bounds[at] : bounds[upto]],
            bounds[at : upto + 1] - bounds[at],
        )
        at = upto


def word_spans(data: np.ndarray, bounds: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text (len + 1 values)."""
    inside = alphabet.word[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = np.zeros(len(data) + 1, bool)
    closes[1:] = inside
    closes[1:-1] &= ~inside[1:]
    heads = bounds[bounds < len(data)]
    opens[heads] = inside[heads]
    tails = bounds[bounds > 0]
    closes[tails] = inside[tails - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes), np.searchsorted(starts, bounds)


_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, PIECE)
        _powers = np.full(size, _RADIX, _U)
        _powers[0] = 1
        np.cumprod(_powers, out=_powers)
        _inverses = np.full(size, _INVERSE, _U)
        _inverses[0] = 1
        np.cumprod(_inverses, out=_inverses)
    return _powers, _inverses


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each ascending byte span, the same wherever the span stands."""
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        base = starts[at]
        upto = int(np.searchsorted(ends, base + PIECE, "right"))
        if upto <= at:  # one span of more than PIECE bytes
            raw = codes[data[base : ends[at]]].tobytes()
            out[at] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
            at += 1
            continue
        part = data[base : ends[upto - 1]]
        powers, inverses = _tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(codes[part] * powers[: len(part)], out=sums[1:])
        first, last = starts[at:upto] - base, ends[at:upto] - base
        found = (sums[last] - sums[first]) * inverses[first]
        out[at:upto] = mix(found + (last - first).astype(_U) * _U(_RADIX))
        at = upto
    return out


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Distinct `width`-word shingle hashes of each text, ascending.

    A text with fewer words gives one shingle of all its words, a text without words none.
    """
    full = len(hashes) - width + 1
    if full > 0:
        sums = hashes[:full] * _PLACES[0]
        for k in range(1, width):
            sums += hashes[k : k + full] * _PLACES[k]
        sums = mix(sums)
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        n = last - first
        if n >= width:
            found = np.sort(sums[first : last - width + 1])
            fresh = np.empty(len(found), bool)
            fresh[0] = True
            np.not_equal(found[1:], found[:-1], out=fresh[1:])
            yield found[fresh]
        elif n:
            whole = (hashes[first:last] * _PLACES[:n]).sum() + _U(n)
            yield mix(np.array([whole], _U))
        else:
            yield np.zeros(0, _U)


def texts_shingles(batch: pa.RecordBatch, column: str, width: int, alphabet: Alphabet = SPACED):
    """(slice of the batch, list of shingle sets) for each piece of a batch."""
    for part, data, bounds in pieces(batch, column):
        starts, ends, words = word_spans(data, bounds, alphabet)
        hashes = span_hashes(data, starts, ends, alphabet.code)
        yield part, list(shingle_sets(hashes, words, width))
