"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

Every run of `width` words of a benchmark item is a pattern; an item of fewer words is one pattern.
Patterns of one length make one search: a shift table over hashed blocks of two words says how far
the window may move, a table of suffix and prefix blocks selects the patterns where it may not, and
the words themselves are compared before anything counts. All windows of an Arrow batch move
together, in segments, so a very long text takes no more rounds than a short one.

The benchmark's texts reach the tasks as broadcasts of at most ITEM_BYTES each; a larger benchmark
is split into as many searches over the documents as that takes, which add up in the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.text import ALNUM, _PLACES, apart, mix, pieces, span_hashes, word_spans

#: Bytes of benchmark text in one broadcast.
ITEM_BYTES = 1 << 22
#: Window positions that move together as one segment, and slots of a shift table.
_SEGMENT, _SLOTS = 128, 1 << 20

RESULTS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
_KINDS = [T.LongType(), T.LongType(), T.LongType(), T.StringType(), T.BooleanType()]


def _blocks(words: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of `size` words that ends at each position of `last`."""
    out = words[last] * _PLACES[1]
    if size == 2:
        out = out + words[last - 1] * _PLACES[2]
    return mix(out)


@dataclass
class _Search:
    """The tables for patterns of one length."""

    length: int
    block: int
    shift: np.ndarray
    keys: np.ndarray  # suffix and prefix block of each pattern, ascending
    begin: np.ndarray  # first word of each pattern in the items' words
    item: np.ndarray

    @classmethod
    def over(cls, words: np.ndarray, begin: np.ndarray, item: np.ndarray, length: int) -> _Search:
        block = min(2, length)
        shift = np.full(_SLOTS, length - block + 1, np.int16)
        for back in range(length - block + 1):
            slots = (_blocks(words, begin + length - 1 - back, block) & np.uint64(_SLOTS - 1)).astype(np.int64)
            np.minimum.at(shift, slots, back)
        keys = cls._key(words, begin, length, block)
        order = np.argsort(keys, kind="stable")
        return cls(length, block, shift, keys[order], begin[order], item[order])

    @staticmethod
    def _key(words: np.ndarray, begin: np.ndarray, length: int, block: int) -> np.ndarray:
        suffix = _blocks(words, begin + length - 1, block)
        return mix(suffix + _blocks(words, begin + block - 1, block) * _PLACES[3])

    def stops(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First words of the windows that the shift table doesn't let pass."""
        ends, low = bounds[1:], bounds[:-1] + self.length - 1
        counts = np.maximum(-(-(ends - low) // _SEGMENT), 0)
        text = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = low[text] + nth * _SEGMENT
        upto = np.minimum(at + _SEGMENT, ends[text])
        found = []
        while len(at):
            slots = (_blocks(words, at, self.block) & np.uint64(_SLOTS - 1)).astype(np.int64)
            move = self.shift[slots]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            on = at < upto
            at, upto = at[on], upto[on]
        return np.concatenate([np.zeros(0, np.int64), *found]) - self.length + 1

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word of a window, pattern) whose suffix and prefix blocks agree."""
        at = self.stops(words, bounds)
        keys = self._key(words, at, self.length, self.block)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        counts = high - low
        pattern = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.repeat(at, counts), pattern


class _Benchmark:
    def __init__(self, items: list[tuple[str, str]], width: int):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        batch = pa.RecordBatch.from_pydict({"text": pa.array([text for _, text in items], pa.string())})
        words, begins, lengths, owners = [np.zeros(0, np.uint64)], [], [], []
        spans, raws, at, row = [], [], 0, 0
        for part, data, bounds in pieces(batch, "text"):
            starts, ends, first = word_spans(data, bounds, ALNUM)
            words.append(span_hashes(data, starts, ends, ALNUM.code))
            spans.append(np.stack([starts, ends], 1) + sum(len(r) for r in raws))
            raws.append(ALNUM.fold[data])
            for i in range(part.num_rows):
                n = int(first[i + 1] - first[i])
                size = min(width, n)
                some = np.arange(first[i], first[i + 1] - size + 1) + at if n else np.zeros(0, np.int64)
                begins.append(some)
                lengths.append(np.full(len(some), size))
                owners.append(np.full(len(some), number[items[row][0]]))
                row += 1
            at += len(starts)
        self.words = np.concatenate(words)
        self.spans = np.concatenate([np.zeros((0, 2), np.int64), *spans])
        self.raw = b"".join(r.tobytes() for r in raws)
        begin, length, owner = (
            np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (begins, lengths, owners)
        )
        self.searches = [
            _Search.over(self.words, begin[length == n], owner[length == n], int(n)) for n in np.unique(length)
        ]

    def _same(self, search: _Search, pattern: int, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int) -> bool:
        begin = search.begin[pattern]
        for k in range(search.length):
            a, b = self.spans[begin + k]
            if ALNUM.fold[data[starts[at + k] : ends[at + k]]].tobytes() != self.raw[a:b]:
                return False
        return True

    def occurrences(self, data: np.ndarray, bounds: np.ndarray):
        """First word of each text, and (first word, length, item) of every occurrence."""
        starts, ends, first = word_spans(data, bounds, ALNUM)
        words = span_hashes(data, starts, ends, ALNUM.code)
        found = []
        for search in self.searches:
            at, pattern = search.candidates(words, first)
            equal = np.ones(len(at), bool)
            for k in range(search.length):
                equal &= words[at + k] == self.words[search.begin[pattern] + k]
            for a, p in zip(at[equal].tolist(), pattern[equal].tolist(), strict=True):
                if self._same(search, p, data, starts, ends, a):
                    found.append((a, search.length, int(search.item[p])))
        return first, found


_built: list[tuple[object, _Benchmark]] = []


def _benchmark(items: list[tuple[str, str]], width: int) -> _Benchmark:
    """The worker's tables for a broadcast list; a worker keeps one set."""
    if not _built or _built[0][0] is not items:
        _built[:] = [(items, _Benchmark(items, width))]
    return _built[0][1]


def _search(items, width: int, carried: list[str], more: bool):
    """more: leave spans and items of a document in the row for the next search."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _benchmark(items.value, width)
        for batch in batches:
            for part, data, bounds in pieces(batch, "_text"):
                first, found = own.occurrences(data, bounds)
                counts = np.diff(first)
                spans: list[list[int]] = [[] for _ in counts]
                names: list[set[str]] = [set() for _ in counts]
                if "_spans" in batch.schema.names:
                    spans = [x or [] for x in part.column("_spans").to_pylist()]
                    names = [set(x or []) for x in part.column("_items").to_pylist()]
                places = np.searchsorted(first, [a for a, _, _ in found], "right") - 1
                for (a, length, item), i in zip(found, places.tolist(), strict=True):
                    spans[i] += [a - int(first[i]), a - int(first[i]) + length]
                    names[i].add(own.names[item])
                columns = [part.column(c) for c in carried]
                if more:
                    extra = [pa.array(spans, pa.list_(pa.int64())), pa.array([sorted(x) for x in names], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*columns, *extra], [*carried, "_spans", "_items"])
                    continue
                hits = np.zeros(len(counts), np.int64)
                for i, flat in enumerate(spans):
                    if flat:
                        step = np.zeros(counts[i] + 1, np.int64)
                        np.add.at(step, flat[::2], 1)
                        np.add.at(step, flat[1::2], -1)
                        hits[i] = (np.cumsum(step) > 0).sum()
                digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in names]
                extra = [pa.array(counts, pa.int64()), pa.array(hits, pa.int64())]
                extra += [pa.array([len(x) for x in names], pa.int64()), pa.array(digests), pa.array(hits > 0)]
                yield pa.RecordBatch.from_arrays([*columns, *extra], [*carried, *RESULTS])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Documents with n_words, n_hit, n_items, items_sha256 and contaminated.

    Takes `text` of the documents and `item_id`, `text` of the benchmark. Letters A-Z are folded;
    words are runs of ASCII letters, digits and characters outside ASCII. All other columns of the
    documents stay, but for those named like a result, which are replaced. A null text has no words;
    so has an item, which then matches nothing. Rows that share an item_id are one item; a null
    item_id counts as the id ''. An empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(*apart(docs, keep), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    own = rows.columns[:-1]
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // ITEM_BYTES))
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        held = spark.sparkContext.broadcast([(r[0], r[1]) for r in part.toLocalIterator()])
        more = shard < shards - 1
        carried = [*own, "_text"] if more else own
        fields = [rows.schema[c] for c in carried]
        if more:
            fields += [T.StructField("_spans", T.ArrayType(T.LongType())), T.StructField("_items", T.ArrayType(T.StringType()))]
        else:
            fields += [T.StructField(c, k) for c, k in zip(RESULTS, _KINDS, strict=True)]
        rows = rows.mapInArrow(_search(held, width, carried, more), T.StructType(fields))
    return rows.toDF(*keep, *RESULTS)
