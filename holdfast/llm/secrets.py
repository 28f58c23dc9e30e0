"""Secrets in texts: fixed patterns, and credential values that would be costly to guess.

The guess cost of a value is the smallest sum, over all ways of cutting it into spans, of the log10
of the guesses each span takes: a word by its rank, a date, a repeated unit, a walk along keyboard rows or
an alphabet, or single characters by brute force. Words are a few that passwords favour, then those
that the documents themselves use most. The cost is found by dynamic programming over end positions; every kind
but walks and repeats has a bounded length, so a value of any length takes time in proportion to it. Values behind credential words whose cost reaches the limit
are added as spans of kind `guess`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.text import apart

RESULTS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"]
_KINDS = [T.LongType(), T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.LongType()]

# The base patterns.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs of the pattern's class, of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words that announce a credential, and what stands between them and its value. A quote that opens the
#: value takes it to the same quote on its line, escaped ones passed over; otherwise the value is bare.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|credentials?|secret|token|auth|bearer|(?:api|access|private|secret)[_ -]?key)"
    r"[\"']?[ \t]*(?::|=>?)[ \t]*"
    r"(?:\"((?:[^\"\\\r\n]|\\[^\r\n])*+)\"|'((?:[^'\\\r\n]|\\[^\r\n])*+)'|[\"']?([^\s\"'<>,;(){}]{6,}))",
    re.IGNORECASE | re.ASCII,
)
#: log10 of the guesses from which a value counts as a secret.
GUESSES = 8.0

#: Words common in passwords and placeholders, the most common first.
WORDS = (
    "password pass admin welcome login letmein qwerty dragon monkey master hello freedom whatever shadow sunshine "
    "princess football baseball iloveyou trustno secret changeme default example sample test testing guest user root "
    "token key none null true false todo your here value string enter insert placeholder dummy redacted hidden "
    "company server service account public private access summer winter spring autumn monday friday january october "
    "love money angel star lucky happy super magic tiger eagle hunter killer batman jordan michael thomas daniel"
).split()
#: So many words are ranked, of lengths within these.
RANKED, SHORTEST, LONGEST = 20_000, 3, 16
#: Letters that digits and marks stand for.
_LEET = str.maketrans("0134578@$!", "oieastbasi")

#: Rows to walk along, one place at a time, either way.
ROWS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz"]
_STEPS = {pair for row in ROWS for a, b in zip(row, row[1:], strict=False) for pair in (a + b, b + a)}

_DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-/.])(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d"
)
#: log10 guesses: one character by brute force, a date, a year.
_CHARACTER, _DAY, _YEAR = 1.0, math.log10(365 * 130), math.log10(130)


def _case(text: str) -> float:
    """log10 of the ways in which a word's letters may be upper case."""
    upper = sum(c.isupper() for c in text)
    if not upper:
        return 0.0
    if text.isupper() or (upper == 1 and text[0].isupper()):
        return math.log10(2)
    return math.log10(sum(math.comb(len(text), k) for k in range(1, upper + 1)))


def ranks(corpus: Iterable[str] = ()) -> dict[str, int]:
    """Rank of each word, from 1: WORDS, then other words in the order given."""
    return {word: rank for rank, word in enumerate(dict.fromkeys([*WORDS, *corpus]), 1)}


def frequent_words(docs: DataFrame) -> list[str]:
    """The RANKED most frequent words of all texts (ties in order), lower case, the first most frequent."""
    word = rf"\p{{L}}{{{SHORTEST},}}"
    words = docs.select(F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(word), F.lit(0))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))  # one row a form before the fold
    folded = counted.groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    top = folded.where(F.length("word") <= LONGEST).orderBy(F.desc("n"), "word").limit(RANKED)
    return [row["word"] for row in top.collect()]


_OWN = ranks()


def _spans(value: str, rank_of: dict[str, int] = _OWN) -> dict[int, list[tuple[int, float]]]:
    """Spans that are cheaper than brute force, by their end: (start, log10 guesses)."""
    ends: dict[int, list[tuple[int, float]]] = {}
    low, n = value.lower(), len(value)
    plain = low.translate(_LEET)

    def add(start: int, end: int, cost: float) -> None:
        ends.setdefault(end, []).append((start, cost))

    for start in range(n):
        for end in range(start + SHORTEST, min(n, start + LONGEST) + 1):
            rank = rank_of.get(plain[start:end])
            if rank:
                swaps = sum(a != b for a, b in zip(low[start:end], plain[start:end], strict=True))
                add(start, end, math.log10(rank) + _case(value[start:end]) + swaps * math.log10(2))
        found = _DATE.match(low, start, min(n, start + 10))
        if found:
            add(start, found.end(), _YEAR if found.end() - start == 4 else _DAY)
    start = 0
    while start < n:  # walks
        end = start + 1
        while end < n and low[end - 1 : end + 1] in _STEPS:
            end += 1
        if end - start >= 3:
            # Each turn may come at any step.
            turns = sum(low[k] == low[k - 2] for k in range(start + 2, end))
            add(start, end, math.log10(40 * (end - start)) + turns * math.log10(2 * (end - start)))
        start = max(end - 1, start + 1)
    for unit in (1, 2, 3, 4):  # repeats of a short unit
        start = 0
        while start + 2 * unit <= n:
            end = start + unit
            while low[end : end + unit] == low[start : start + unit]:
                end += unit
            times = (end - start) // unit
            if times >= 2 and end - start >= 3:
                add(start, end, unit * _CHARACTER + math.log10(times))
                start = end
            else:
                start += 1
    return ends


def guess_cost(value: str, rank_of: dict[str, int] = _OWN) -> float:
    """log10 of the guesses that the cheapest way of cutting the value takes; 0 if empty."""
    ends = _spans(value, rank_of)
    cost = [0.0] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        cost[end] = cost[end - 1] + _CHARACTER
        for start, own in ends.get(end, ()):
            cost[end] = min(cost[end], cost[start] + own)
    return cost[-1]


def spans_of(text: str, rank_of: dict[str, int] = _OWN) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of all spans, in order; kinds as in KINDS."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        k = m.lastindex
        if m.end(k) - m.start(k) >= 6 and guess_cost(m[k], rank_of) >= GUESSES:
            found.append((m.start(k), 3, m.end(k)))
    return sorted(found)


KINDS = ["assign", "access", "hex", "guess"]


def _scan(carried: list[str], words):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = ranks(words.value)
        for batch in batches:
            rows = []
            for value in batch.column("_text"):
                found = spans_of(value.as_py(), rank_of)
                names = [f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found]
                base = ",".join(name for name, span in zip(names, found, strict=True) if span[1] < 3)
                counts = [sum(span[1] == k for span in found) for k in range(4)]
                rows.append((*counts[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(names), counts[3]))
            columns = list(zip(*rows, strict=True)) or [[]] * len(RESULTS)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            extra = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *extra], [*carried, *RESULTS])

    return run


def find_secrets(docs: DataFrame) -> DataFrame:
    """All columns of the documents with n_assign, n_access, n_hex, base_sha256, spans and n_guess.

    Spans are `kind:start:end` in code points, end exclusive, comma-joined, by start and then by kind as
    in KINDS. base_sha256 is the digest of the first three kinds' list. A null text is empty; columns
    named like a result are replaced.
    """
    words = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))
    keep = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(*apart(docs, keep), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    own = rows.columns[:-1]
    fields = [rows.schema[c] for c in own] + [T.StructField(c, k) for c, k in zip(RESULTS, _KINDS, strict=True)]
    return rows.mapInArrow(_scan(own, words), T.StructType(fields)).toDF(*keep, *RESULTS)
