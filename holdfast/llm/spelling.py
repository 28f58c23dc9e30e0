"""Spelling variants of words: neighbours by one edit, found in sorted permuterm rotations.

A word w is closed by a terminator, `w$`, and all its rotations are sorted. Leaving out the character c of
w = p c s turns the rotation `s$pc` into its prefix `s$p`: words that replace c have a rotation of that
prefix and one more character, and the word without c is that prefix itself. So every prefix `s$p` is a
range of the sorted rotations that holds the words with one character there, and at most one word
without. A range has one entry per character of the alphabet and one more, however large the vocabulary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.sources.tables import stage

# What a word is made of, and which characters are folded.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMINATOR = "$"
#: Every so many occurrences one is taken as mistyped: it loses a character.
TYPO = 199
FORM_TIMES = 5


def _folded(run: Column) -> Column:
    """A-Z in lower case, nothing else changed; the built-in fold does for runs of ASCII."""
    return F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def _without(word: Column, at: Column) -> Column:
    """The word without its character at `at` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def vocabulary(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6, times: int = 5, typo: int = TYPO
) -> DataFrame:
    """(word, n) of words of at least `least` characters that occur at least `times` times.

    Occurrences are maximal runs of LETTERS, folded. One whose hash with its document's id is divisible by
    `typo` first loses the character that the hash names. A null text has no words, a null id is empty.
    Runs too short to count are not even cut out: a run is taken whole or not at all.
    """
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run"),
    ).select("doc", _folded(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    hashed = runs.select("run", h.alias("h"))
    at = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    word = F.when(F.col("h") % typo == 0, _without(F.col("run"), at)).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= least) & (F.col("n") >= times))


def rotations(words: DataFrame) -> DataFrame:
    """(word, n, head, gap, first) of all prefixes under which a word's rotations are looked up, sorted.

    gap: head is a rotation without its last character, the one at the gap; `first` tells whether that
    character begins a run of equal ones, so that each deletion of a word is taken once. Otherwise head is the
    whole rotation.
    """
    size, word = F.length("word"), F.col("word")
    gaps = words.select("word", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"), F.lit(True).alias("gap"))
    wholes = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("at"), F.lit(False).alias("gap"))
    at, skip = F.col("at"), F.when(F.col("gap"), 1).otherwise(0)
    head = F.concat(F.substring(word, at + skip + 1, F.length(word)), F.lit(TERMINATOR), F.substring(word, F.lit(1), at))
    own, before = F.substring(word, at + 1, F.lit(1)), F.substring(word, at, F.lit(1))
    found = gaps.unionByName(wholes).select(
        "word", "n", head.alias("head"), "gap", ((at == 0) | (own != before)).alias("first")
    )
    return found.repartitionByRange("head").sortWithinPartitions("head")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of every word with a neighbour: how many words differ by exactly one
    inserted, deleted or replaced character, and the one of largest n (ties: smallest) among them.

    One scan of the sorted ranges: each keeps its two best entries, of which any entry's best neighbour is
    the first or the second, so no pairs are made. Words without entries beside them in any range
    have no neighbour and no row.
    """
    # Best of a range first; what isn't wanted is null and sorts last.
    best = lambda keep: F.when(keep, F.struct((-F.col("n")).alias("less"), F.col("word")))
    span = Window.partitionBy("head")
    gap, first = F.col("gap"), F.col("first")
    ranged = (
        rotations(words)
        .withColumn("gaps", F.count(F.when(gap, 1)).over(span))
        .withColumn("cuts", F.count(F.when(gap & first, 1)).over(span))
        .withColumn("whole", F.min(best(~gap)).over(span))
        .withColumn("cut", F.min(best(gap & first)).over(span))
        .withColumn("one", F.min(best(gap)).over(span))
        .where((F.col("gaps") > 1) | F.col("whole").isNotNull() & (F.col("cuts") > 0))
        .withColumn("two", F.min(best(gap & (F.col("word") != F.col("one.word")))).over(span))
    )
    replaced = F.when(F.col("word") == F.col("one.word"), F.col("two")).otherwise(F.col("one"))
    beside = F.when(gap, F.least(replaced, F.when(first, F.col("whole")))).otherwise(F.col("cut"))
    count = F.when(gap, F.col("gaps") - 1 + F.when(first & F.col("whole").isNotNull(), 1).otherwise(0)).otherwise(
        F.col("cuts")
    )
    return (
        ranged.select("word", count.alias("count"), beside.alias("beside"))
        .groupBy("word")
        .agg(F.sum("count").alias("n_near"), F.min("beside").alias("best"))
        .where("n_near > 0")
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.word").alias("form"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, n, form, form_n) that has a form: the end of its chain of forms.

    Each round a word takes over its root's root, so chains shrink by half. A form is FORM_TIMES as
    frequent as its word, which bounds the chains by the largest count, and so the rounds.
    """
    links = stage(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    most = forms.agg(F.max("form_n")).first()[0] or 1
    longest = int(math.log(most, FORM_TIMES)) + 1
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links = stage(
            links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots"
        )
    return links


def group_variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every (word, n); words must be distinct.

    form is the most frequent neighbour, where it is at least FORM_TIMES as frequent as the word. root
    is reached from a word by its form, that one's form and so on; a word without a form is its own. No
    words give no rows.
    """
    near = neighbours(words)
    kept = F.col("form_n") >= FORM_TIMES * F.col("n")
    found = stage(
        words.join(near, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(kept, F.col("form")).alias("form"),
            F.when(kept, F.col("form_n")).alias("form_n"),
        ),
        "variants",
    )
    return found.join(roots(found), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Variants among the words of documents (doc_id, text; other columns are ignored)."""
    return group_variants(stage(vocabulary(docs), "vocabulary"))
