"""Fuzzy line deduplication with DataFrame functions only.

Lines are compared by the set of their character shingles, and their signatures are made from the same
set. One permutation hashing gives the MinHash signature: the hashed shingles fall into BANDS * ROWS bins
and each bin's smallest is one component. Lines meet in a band where all its bins agree (at a Jaccard
similarity of 0.8, in one of eight bands of four bins for 98.5 % of pairs). In each band every line is
compared with the band's first and last line, on the whole shingle sets; links are closed to components
by distributed union-find. Lines of a band that are then in different components are compared with each
other, large bands dealt out as pairs of blocks, so every two lines that meet are compared or tied. Sizes
and bitmaps of the shingle sets first rule out pairs that can't link. Of all lines of a component the
first occurrence in the corpus stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.components import components
from holdfast.sources.tables import settle, shuffles_freed, stage

#: Bands and bins of a band, as powers of two: 8 and 4.
_BAND_BITS, _ROW_BITS = 3, 2
#: Lines of a block; larger bands are dealt out as pairs of blocks.
BLOCK = 512
#: Shingles that start in a block of a line.
_STARTS = 24
#: 64-bit words of a line's bitmap, a power of two.
WORDS = 16


def _blocks(line: Column, width: int) -> Column:
    """A line cut into blocks that hold the starts of _STARTS shingles each, and the rest of the last one."""
    return F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{1,{_STARTS + width - 1}}})).{{1,{_STARTS}}}"), F.lit(1))


def shingles(line: Column, width: int) -> Column:
    """Hashes of all runs of `width` characters; a shorter line is one shingle."""

    def runs(block: Column) -> Column:
        last = F.length(block) - (width - 1)
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(block, i, F.lit(width))))

    whole = F.length(line) < width
    return F.when(whole, F.array(F.xxhash64(line))).otherwise(F.flatten(F.transform(_blocks(line, width), runs)))


def shingle_rows(lines: DataFrame, width: int) -> DataFrame:
    """(lid, h): a row for each run of `width` characters of (lid, line), with its hash as `shingles` makes it.

    A character string is walked to a place within it, bytes are not: blocks keep the walk short, and
    those of ASCII only are read as bytes.
    """
    block = F.posexplode(_blocks(F.col("line"), width)).alias("at", "block")
    last = F.length("block") - (width - 1)
    cut = lines.select("lid", block).select(
        "lid",
        "block",
        F.col("block").cast("binary").alias("bytes"),
        (F.octet_length("block") == F.length("block")).alias("ascii"),
        F.when(F.col("at") == 0, F.greatest(last, F.lit(1))).otherwise(last).alias("last"),
    )
    starts = cut.where("last > 0").select("lid", "block", "bytes", "ascii", F.explode(F.sequence(F.lit(1), "last")).alias("i"))

    def run(text: str) -> Column:
        return F.xxhash64(F.substring(text, F.col("i"), F.lit(width)))

    return starts.select("lid", F.when(F.col("ascii"), run("bytes")).otherwise(run("block")).alias("h"))


def _once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """Adds columns that are computed once however often later steps name them: the optimizer
    doesn't copy an expression through a generator."""
    row = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select(*keep, F.inline(F.array(row)))


def band_keys(lines: DataFrame, width: int) -> DataFrame:
    """(lid, band) of every line (lid, line) and each of its bands that isn't empty.

    A hash's first bits are its band and bin; of the others 31 are compared. That two lines that differ
    meet by the cut is as rare as it is harmless: pairs that meet are compared on whole shingle sets.

    Line and band number are grouped by as one long, which is looked up faster and shuffled shorter than two columns.
    """
    low = 64 - _BAND_BITS - _ROW_BITS
    placed = shingle_rows(lines, width).select(
        (F.col("lid") * (1 << _BAND_BITS) + F.shiftrightunsigned("h", 64 - _BAND_BITS)).alias("slot"),
        F.shiftrightunsigned("h", low).bitwiseAND((1 << _ROW_BITS) - 1).cast("int").alias("bin"),
        F.shiftrightunsigned("h", low - 31).bitwiseAND((1 << 31) - 1).cast("int").alias("rest"),
    )
    least = [F.min(F.when(F.col("bin") == k, F.col("rest"))).alias(f"m{k}") for k in range(1 << _ROW_BITS)]
    n = F.col("slot").bitwiseAND((1 << _BAND_BITS) - 1).cast("int")
    key = F.xxhash64(n, *(F.coalesce(f"m{k}", F.lit(-1)) for k in range(1 << _ROW_BITS)))
    return placed.groupBy("slot").agg(*least).select(F.shiftright("slot", _BAND_BITS).alias("lid"), key.alias("band"))


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n, line) of every line that isn't blank. row tells rows of one doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return lines.where(F.trim("line") != "")


def _sketches(lines: DataFrame, width: int) -> DataFrame:
    """(lid, size, w0, w1, ...): size of a line's shingle set and a bitmap, in which each shingle turns one bit.

    Shingles of both of two lines cancel out: bits that differ are at most as many as shingles in one set only.
    """
    sets = _once(lines, "lid", hashes=F.array_distinct(shingles(F.col("line"), width)))
    rows = sets.select("lid", F.explode("hashes").alias("h"))
    # Not the first bits: within a band these are the same for lines that meet.
    placed = rows.select(
        "lid",
        F.shiftrightunsigned("h", 6).bitwiseAND(WORDS - 1).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(63).cast("int")).alias("bit"),
    )
    none = F.lit(0).cast("long")
    words = [F.bit_xor(F.when(F.col("word") == k, F.col("bit")).otherwise(none)).alias(f"w{k}") for k in range(WORDS)]
    return placed.groupBy("lid").agg(F.count("*").cast("int").alias("size"), *words)


def _rest(distinct: DataFrame, banded: DataFrame, ends: DataFrame, tied: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(a, b) of lines that meet in a band, are in different components and may link.

    Bands of up to three lines have no other pairs than those with their ends.
    """
    inner = banded.join(ends.where("members > 3"), "band").where("lid != low AND lid != high").select("band", "lid")
    inner = inner.join(tied, "lid", "left").select("band", "lid", F.coalesce("root", "lid").alias("root"))
    split = inner.groupBy("band").agg(F.min("root").alias("one"), F.max("root").alias("two"), F.count("*").alias("members"))
    split = split.where("one < two").select("band", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    inner = stage(inner.join(split, "band"), "inner")

    words = [f"w{i}" for i in range(WORDS)]
    sketch = stage(_sketches(_texts(distinct, inner.select("lid")), width), "sketches")
    cells = inner.withColumn("own", F.pmod(F.xxhash64("lid"), F.col("blocks")).cast("int"))
    cells = cells.join(sketch, "lid").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "lid", "root", "size", *words
    )
    x, y = cells.alias("x"), cells.alias("y")
    # In a cell of two blocks each pair has one line of either; in a cell of one block the ids' order tells them apart.
    met = (F.col("x.own") < F.col("y.own")) | ((F.col("x.i") == F.col("x.j")) & (F.col("x.lid") < F.col("y.lid")))
    differ = sum((F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in words), F.lit(0))
    small, large = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    may = (small * den >= large * num) & (differ * (den + num) <= (small + large) * (den - num))
    same = (F.col("x.band") == F.col("y.band")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    pairs = x.join(y, same & (F.col("x.root") != F.col("y.root")) & met & may)
    return pairs.select(F.least("x.lid", "y.lid").alias("a"), F.greatest("x.lid", "y.lid").alias("b")).distinct()


def _texts(distinct: DataFrame, lids: DataFrame) -> DataFrame:
    """(lid, line) of the lines in `lids`. The ids are hashed, so the texts of all lines are not sorted."""
    return distinct.select("lid", "line").join(lids.distinct().hint("shuffle_hash"), "lid", "left_semi")


def _links(pairs: DataFrame, distinct: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) of lines that link, by their whole shingle sets."""
    text = distinct.select("lid", "line")
    one, two = text.toDF("a", "line_a"), text.toDF("b", "line_b")
    both = pairs.join(one, "a").join(two, "b")
    sets = _once(both, "a", "b", x=F.array_distinct(shingles(F.col("line_a"), width)), y=F.array_distinct(shingles(F.col("line_b"), width)))
    sizes = _once(sets, "a", "b", nx=F.size("x"), ny=F.size("y"), common=F.size(F.array_intersect("x", "y")))
    return sizes.where(F.col("common") * den >= (F.col("nx") + F.col("ny") - F.col("common")) * num).select("a", "b")


def _meetings(banded: DataFrame) -> DataFrame:
    """(band, lid, low, high, members) of each line (lid, band) and band that holds more than one line."""
    banded = banded.repartition("band")
    ends = banded.groupBy("band").agg(F.min("lid").alias("low"), F.max("lid").alias("high"), F.count("*").alias("members"))
    met = banded.join(ends.where("low < high").hint("shuffle_hash"), "band")
    return met.select("band", "lid", "low", "high", "members")


def _tied(distinct: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(lid, root) of every line (lid, line) that links with another."""
    met = stage(_meetings(band_keys(distinct, width)), "met")
    near = stage(_texts(distinct, met.select("lid")), "texts")
    pairs = met.select("lid", F.explode(F.array("low", "high")).alias("other"))
    pairs = pairs.select(F.least("lid", "other").alias("a"), F.greatest("lid", "other").alias("b")).where("a < b").distinct()
    links = stage(_links(stage(pairs, "pairs"), near, width, num, den), "links")
    tied = components(links).withColumnRenamed("id", "lid")
    ends = met.where("lid = low").drop("lid")
    rest = stage(_rest(near, met.select("band", "lid"), ends, tied, width, num, den), "rest")
    more = stage(_links(rest, near, width, num, den), "more")
    if not more.isEmpty():
        edges = more.unionByName(tied.select(F.col("lid").alias("a"), F.col("root").alias("b")))
        tied = components(edges).withColumnRenamed("id", "lid")
    return tied


def _hashes() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def line_decisions(docs: DataFrame, width: int = 7, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, row, n_lines, n_dropped and dropped (their numbers from 0, ascending) per document.

    Two distinct lines link when den * |A and B| >= num * |A or B| over their character shingles; equal
    lines are one. The line that stays is the one with the smallest doc_id (nulls last), then row (a
    hash of the text), then number. Blank lines stay; a null text is one blank line. Rows that repeat
    doc_id and text wholly share one result row, with `copies`.

    What the search for links stages and shuffles is deleted on the way: it holds the disk of one step.
    """
    with shuffles_freed(docs.sparkSession):
        return _decisions(docs, width, num, den)


def _decisions(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    where = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n")
    lines = _numbered(docs).select("doc_id", "row", "n", "line", *_hashes())
    distinct = lines.groupBy("h1", "h2").agg(F.min(where).alias("at"), F.first("line").alias("line"), F.count("*").alias("places"))
    distinct = stage(distinct.withColumn("lid", F.monotonically_increasing_id()), "lines")

    tied = settle(docs.sparkSession, lambda: _tied(distinct, width, num, den), "tied")

    # A line that stands in one place and is tied to no other stays.
    known = distinct.select("lid", "h1", "h2", "at", "places")
    heads = known.join(tied.hint("shuffle_hash"), "lid")
    first = heads.groupBy("root").agg(F.min("at").alias("keep"))
    alone = known.where("places > 1").join(tied, "lid", "left_anti")
    kept = heads.join(first, "root").select("h1", "h2", "keep").unionByName(alone.select("h1", "h2", F.col("at").alias("keep")))
    places = lines.select("doc_id", "row", "n", "h1", "h2").join(kept.hint("shuffle_hash"), ["h1", "h2"])
    lost = places.where(~F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n").eqNullSafe(F.col("keep")))
    gone = lost.select("doc_id", "row", "n").distinct().groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("n")).alias("dropped"))

    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("row"), F.size(F.split(body, "\n")).cast("long").alias("n_lines")
    )
    every = every.groupBy("doc_id", "row", "n_lines").agg(F.count("*").alias("copies"))
    gone = gone.withColumnRenamed("doc_id", "_doc").withColumnRenamed("row", "_row")
    out = every.join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row")), "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return out.select("doc_id", "row", "copies", "n_lines", F.size(dropped).cast("long").alias("n_dropped"), dropped.alias("dropped"))


def drop_repeated_lines(docs: DataFrame, width: int = 7, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all their columns, with the lines that stay. A text none of whose lines stay is empty."""
    found = line_decisions(docs, width, num, den).where("n_dropped > 0")
    # All columns as one, so that no name can clash.
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"))
    own = F.col("record.text")
    body = F.coalesce(own.cast("string"), F.lit(""))
    same = F.col("record.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(body) == F.col("row"))
    gone = F.map_from_arrays(F.col("dropped"), F.col("dropped"))
    rest = F.filter(F.split(body, "\n"), lambda line, n: ~F.map_contains_key(gone, n))
    text = F.when(F.col("dropped").isNull(), own).otherwise(F.array_join(rest, "\n"))
    joined = rows.join(found.select("doc_id", "row", "dropped"), same, "left")
    return joined.select(*((text if c == "text" else F.col(f"record.`{c}`")).alias(c) for c in docs.columns))
