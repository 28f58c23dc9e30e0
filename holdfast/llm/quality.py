"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins. Cyclic boosting visits one feature after the other and adds
a small step of a shallow tree over its bins, fitted to the current gradients; since a tree over one
feature is a table over its bins, all trees of a feature add up to one lookup table. The pairs of
features with the largest remaining gain are then boosted alike, with trees that split both. A score
is the logistic function of the intercept plus one table entry per feature and per pair.

Training sees a sample of labelled rows of at most `max_rows`; its bound does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.text import SPACED, apart, pieces, span_hashes, word_spans

FEATURES = [
    "log_bytes", "word_bytes", "upper", "digits", "points", "marks", "outside_ascii", "distinct_words",
    "top_word", "repeated_word", "distinct_pairs", "function_words", "log_lines", "line_bytes",
    "repeated_lines", "open_lines", "marked_words",
]
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it for was with as on be at by this are from or an which not "
    "der die das und in zu den von mit ist des für auf dem ein eine auch sich nicht als "
    "de la le les et des en un une du que dans est pour qui sur au par pas avec "
    "el los las y del se por con una su para como al lo más pero sus es"
).split()

RESULTS = ["held_out", "score", "predicted"]


def _words_hash(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) + 1 for w in raw])
    starts = ends - [len(w) + 1 for w in raw]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    return np.unique(span_hashes(data, starts, ends - 1, SPACED.code))


_FUNCTION = _words_hash(FUNCTION_WORDS)
_UPPER, _DIGIT, _POINT, _MARK, _OUTSIDE = (np.zeros(256, bool) for _ in range(5))
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT[ord("0") : ord("9") + 1] = True
_POINT[[ord(c) for c in ".,;:'\"?-()"]] = True
_OUTSIDE[0x80:] = True
_MARK[0x21:0x7F] = True
_MARK &= ~_POINT & ~_DIGIT
_MARK[ord("A") : ord("Z") + 1] = _MARK[ord("a") : ord("z") + 1] = False


def _distinct(values: np.ndarray) -> tuple[int, int]:
    """Number of distinct values and how often the most frequent one stands."""
    ordered = np.sort(values)
    edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return len(edges), int(np.diff(np.append(edges, len(ordered))).max())


def _within(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(mask))[bounds]).astype(float)


def text_features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; shares of an empty text are 0."""
    size = np.diff(bounds).astype(float)
    starts, ends, first = word_spans(data, bounds, SPACED)
    hashes = span_hashes(data, starts, ends, SPACED.code)
    n_words = np.diff(first).astype(float)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n_words, 1)

    breaks = np.flatnonzero(data == 0x0A)
    heads = np.union1d(bounds[:-1], breaks + 1)
    heads = heads[heads < len(data)]
    tails = np.append(heads[1:], len(data))[: len(heads)]
    tails = tails - ((tails > heads) & (data[tails - 1] == 0x0A))
    filled = tails > heads
    heads, tails = heads[filled], tails[filled]
    lines = span_hashes(data, heads, tails, SPACED.code)
    line_first = np.searchsorted(heads, bounds)
    n_lines = np.diff(line_first).astype(float)
    closed = np.isin(data[tails - 1], [ord(c) for c in ".!?\"':;)"]) if len(tails) else np.zeros(0, bool)

    shape = np.zeros((len(size), 4))
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) else hashes
    for i in range(len(size)):
        a, b = first[i], first[i + 1]
        if b > a:
            many, most = _distinct(hashes[a:b])
            shape[i, 0], shape[i, 1] = many / (b - a), most / (b - a)
            shape[i, 2] = _distinct(pairs[a : b - 1])[0] / (b - a - 1) if b > a + 1 else 1
        a, b = line_first[i], line_first[i + 1]
        if b > a:
            shape[i, 3] = 1 - _distinct(lines[a:b])[0] / (b - a)
    again = np.append(False, hashes[1:] == hashes[:-1]) if len(hashes) else np.zeros(0, bool)
    again[first[:-1][first[:-1] < len(again)]] = False
    marked = _MARK[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    letters = np.maximum(size - _within(_DIGIT[data] | _MARK[data] | _POINT[data], bounds), 1)
    return np.column_stack(
        [
            np.log1p(size),
            _within(SPACED.word[data], bounds) / per_word,
            _within(_UPPER[data], bounds) / letters,
            _within(_DIGIT[data], bounds) / per_byte,
            _within(_POINT[data], bounds) / per_byte,
            _within(_MARK[data], bounds) / per_byte,
            _within(_OUTSIDE[data], bounds) / per_byte,
            shape[:, 0],
            shape[:, 1],
            _within(again, first) / per_word,
            shape[:, 2],
            _within(np.isin(hashes, _FUNCTION), first) / per_word,
            np.log1p(n_lines),
            size / np.maximum(n_lines, 1),
            shape[:, 3],
            1 - _within(closed, line_first) / np.maximum(n_lines, 1),
            _within(marked, first) / per_word,
        ]
    )


@dataclass
class AdditiveModel:
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)])

    def scores(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The best place to split a run of bins in two, and its gain; 0 for none."""
    if len(g) < 2:
        return 0, 0.0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return (at + 1, float(gains[at])) if gains[at] > 1e-9 else (0, 0.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over one feature's bins, split where it gains most; its value in each bin."""
    parts = [(0, len(g), *_cut(g, h))]
    while len(parts) < leaves:
        best = max(range(len(parts)), key=lambda k: parts[k][3])
        low, high, at, gain = parts[best]
        if not gain:
            break
        parts[best : best + 1] = [
            (low, low + at, *_cut(g[low : low + at], h[low : low + at])),
            (low + at, high, *_cut(g[low + at : high], h[low + at : high])),
        ]
    out = np.zeros(len(g))
    for low, high, _, _ in parts:
        out[low:high] = _leaf(g[low:high].sum(), h[low:high].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree that splits the first feature once and each side by the second."""
    best, out = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        at, _ = _cut(a.sum(1), b.sum(1))
        if not at:
            continue
        table, gain = np.zeros_like(a), 0.0
        for rows in (slice(0, at), slice(at, None)):
            own_g, own_h = a[rows].sum(0), b[rows].sum(0)
            cut, _ = _cut(own_g, own_h)
            for cols in (slice(0, cut), slice(cut, None)) if cut else (slice(None),):
                table[rows, cols] = _leaf(own_g[cols].sum(), own_h[cols].sum())
                gain += _gain(own_g[cols].sum(), own_h[cols].sum())
        if gain > best:
            best, out = gain, table.T if flip else table
    return out, best


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, leaves: int = 4, pairs: int = 8,
    pair_rounds: int = 60, rate: float = 0.15,
) -> AdditiveModel:
    """Boost the tables. Without rows, or with one class, the tables stay flat near the class's rate."""
    shares = np.arange(1, bins) / bins
    edges = [np.unique(np.quantile(x[:, k], shares)) if len(x) else np.zeros(0) for k in range(x.shape[1])]
    rate_of_ones = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(edges, float(np.log(rate_of_ones / (1 - rate_of_ones))), [np.zeros(len(e) + 1) for e in edges], [], [])
    if not len(y):
        return model
    at = model.bins(x)
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(
                np.bincount(at[:, k], g, len(table)), np.bincount(at[:, k], h, len(table)), leaves
            )
            table += step
            total += step[at[:, k]]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        wide = len(model.tables[j])
        return np.bincount(at[:, i] * wide + at[:, j], v, len(model.tables[i]) * wide).reshape(-1, wide)

    g, h = slopes()
    gains = {(i, j): _pair_tree(grid(i, j, g), grid(i, j, h))[1] for i, j in combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:pairs]
    model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            table += step
            total += step[at[:, i], at[:, j]]
    return model


def _features_of(carried: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in pieces(batch, "_text"):
                x = text_features(data, bounds)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), listed], [*carried, "features"])

    return run


def _score(model, carried: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in pieces(batch, "_text"):
                score = model.value.scores(text_features(data, bounds))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(score)], [*carried, "score"])

    return run


def held_out(doc_id) -> Column:
    """Rows never learnt from: crc32 of the doc_id's text is divisible by 5. False without a doc_id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> AdditiveModel:
    """Fit on labelled documents that are not held out, at most `max_rows` labels chosen by hash.

    Labels without doc_id or quality, or without a document, are left out.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).where(~held_out(F.col("doc_id")))
    chosen = usable.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    rows = docs.select("doc_id", _text()).join(F.broadcast(chosen), "doc_id").select("quality", "_text")
    found = rows.mapInArrow(_features_of(["quality"]), f"quality {dict(rows.dtypes)['quality']}, features array<double>")
    # A doc_id that many rows share would bring them all: the sample stays bounded.
    sample = found.limit(2 * max_rows).collect()
    x = np.array([r[1] for r in sample], float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, np.array([r[0] for r in sample], float)])
    return fit(x[order], np.array([r[0] for r in sample], float)[order])


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 20_000
) -> DataFrame:
    """All columns of the documents with held_out, score (0 to 1) and predicted (score >= threshold).

    Only the text is scored. A null text is empty; an empty one has a score too. Columns named like a
    result are replaced. Without usable labels every score is 0.5; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))
    keep = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(*apart(docs, keep), _text())
    own = rows.columns[:-1]
    fields = [rows.schema[c] for c in own] + [T.StructField("score", T.DoubleType())]
    scored = rows.mapInArrow(_score(model, own), T.StructType(fields))
    return scored.select(
        *[F.col(c).alias(name) for c, name in zip(own, keep, strict=True)],
        held_out(F.col(own[keep.index("doc_id")])).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
