"""Semi-joins of large event tables that shuffle few rows of strangers.

`restrict` keeps the events of wanted keys. Few keys are broadcast. More keys become a Bloom filter: a bit set
whose size follows their number up to MAX_BITS, built by one aggregate and handed to the scan of the events
as a scalar subquery, so that events of other keys go before the shuffle. The exact semi-join
follows: what the filter lets through by chance costs a shuffled row and changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that are broadcast whole (an estimate 5 % off on average; keys are ids of some tens of bytes).
BROADCAST_KEYS = 50_000
#: Bits for a key, bits a key sets, and the bounds of a filter: 8 KB to 4 MB.
BITS_PER_KEY, SET_BITS = 12, 3
MIN_BITS, MAX_BITS = 1 << 16, 1 << 25
#: A page of the filter holds 1,024 words of 64 bits.
PAGE = 1024


def filter_bits(keys: int) -> int:
    """Bits for so many keys: a power of two within the bounds; beyond them more strangers pass."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (max(1, keys) * BITS_PER_KEY - 1).bit_length()))


def _place(columns: Sequence[str], bits: int) -> tuple[Column, Column]:
    """The word of a key, and its bits there. All lie in one word, so a test is one look-up."""
    word = F.pmod(F.xxhash64(*columns), F.lit(bits // 64))
    second = F.xxhash64(F.lit(1), *columns)
    mask = F.lit(0).cast("long")
    for k in range(SET_BITS):
        at = F.shiftright(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return word, mask


def bloom_filter(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """One row, `pages`: the filter as pages of 64-bit words.

    Words are OR-combined before they are shuffled and make pages on their own, so no task sorts the whole
    filter; the last step puts at most MAX_BITS / 65,536 pages in order. Words without a bit are there too.
    """
    word, mask = _place(columns, bits)
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = keys.select(word.alias("word"), mask.alias("mask")).unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))

    def in_order(at: str, value: str) -> Column:
        return F.sort_array(F.collect_list(F.struct(at, value))).getField(value).alias(f"{value}s")

    pages = words.groupBy(F.expr(f"word div {PAGE}").alias("page")).agg(in_order("word", "mask"))
    return pages.agg(in_order("page", "masks").alias("pages"))


def may_hold(pages: Column, columns: Sequence[str], bits: int) -> Column:
    """True for every key of the filter, and for few others."""
    word, mask = _place(columns, bits)
    page = F.get(pages, F.shiftright(word, PAGE.bit_length() - 1).cast("int"))
    return F.get(page, word.bitwiseAND(F.lit(PAGE - 1)).cast("int")).bitwiseAND(mask) == mask


def restrict(events: DataFrame, keys: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Events whose `columns` are a key. Keys and events without a value in a column meet nothing.

    Counts the keys by a sketch when it is called, so hand it a table or something as cheap.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    wanted = keys.select(*columns).dropna()
    number = wanted.agg(F.approx_count_distinct(F.struct(*columns)).alias("n")).first()["n"]
    wanted = wanted.distinct()
    if number <= BROADCAST_KEYS:
        return events.join(F.broadcast(wanted), columns, "left_semi")
    bits = filter_bits(number)
    pages = bloom_filter(wanted, columns, bits).scalar()
    return events.where(may_hold(pages, columns, bits)).join(wanted, columns, "left_semi")
