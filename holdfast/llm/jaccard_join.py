"""Exact Jaccard join of documents on word n-grams, searched with signature trees.

1. Documents with equal shingle sets form a class; only classes go on.
2. Prefix filter: under one order of all shingles, two sets that link share one of their first
   n - ceil(t n) + 1 shingles. Shingles that are frequent in a sample come last in the order; that
   keeps common passages out of the prefixes and changes no result.
3. Buckets of classes that share a shingle are searched by signature trees. A node holds the OR of
   its sets' token bitmaps, the range of their sizes and the most tokens that shared a bit; two trees
   are walked together, and a pair of nodes is dropped when its largest possible overlap is too small
   for its sizes, or when both lie in one component.
4. A first search keeps each member's likeliest partner. Those pairs are compared on their texts and
   closed to components, which ties most copies together.
5. A second search goes over the buckets in which the first one held pairs back and which still hold
   several components, and keeps every pair that may link across them. Those are compared too; both
   kinds of links give the components.

Buckets of more than BLOCK members are dealt out as pairs of blocks (cells), so no task holds a
bucket; a text travels once to each cell where it is compared, not once a pair. Before texts are
fetched, pairs are screened on bitmaps whose length follows the set's size, about four bits a token;
the trees hold the same bitmaps folded to _BITS, or to _LARGE_BITS among large sets. Bitmaps are made
in the pass that makes the prefixes, so only texts of pairs that pass the screen are ever shuffled.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.components import components
from holdfast.llm.text import SPACED, mix, texts_shingles
from holdfast.operators.reduction import restrict
from holdfast.sources.tables import settle, shuffles_freed, stage

#: Members of a bucket that one task takes, in one block.
BLOCK = 512
#: Frequent shingles that come last in the order: a broadcast of at most 12 bytes each.
FREQUENT = 1 << 16
#: Bits of a signature, and of one of a set with more than _LARGE shingles.
_BITS, _LARGE_BITS, _LARGE = 2048, 8192, 1500
#: Children of a tree node, node pairs expanded at once.
_FANOUT, _PAIRS = 8, 512
_U = np.uint64


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(_U).view(np.int64), pa.int64())


def _count_repeats(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in texts_shingles(batch, "text", width):
                found, counts = np.unique(np.concatenate([np.zeros(0, _U), *sets]), return_counts=True)
                some = counts > 1
                yield pa.RecordBatch.from_arrays([_as_long(found[some]), pa.array(counts[some], pa.int64())], ["h", "n"])

    return run


def frequent_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) of the most repeated shingles of every sixteenth document, and their places
    in the order, rarest first. Only the order of prefixes depends on them."""
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(16)) == 0).select("text")
    counts = sample.mapInArrow(_count_repeats(width), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    hashes = np.array([r[0] for r in top], np.int64).view(_U)
    order = np.argsort(hashes)
    return hashes[order], (len(top) - np.arange(len(top)))[order].astype(np.int32)


def _prefix(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], num: int, den: int) -> np.ndarray:
    """The first shingles of a set: rare ones by hash, then frequent ones, rarest first."""
    n = len(shingles)
    size = n - -(-num * n // den) + 1
    hashes, places = frequent
    if not len(hashes):
        return shingles[:size]
    at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
    common = hashes[at] == shingles
    rare = shingles[~common][:size]
    if len(rare) == size:
        return rare
    rest = shingles[common][np.argsort(places[at[common]])]
    return np.concatenate([rare, rest[: size - len(rare)]])


def _fingerprint(width: int, num: int, den: int, frequent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in texts_shingles(batch, "text", width):
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate([np.zeros(0, _U), *sets])
                keys = []
                for salt in (1, 2):
                    sums = np.append(_U(0), np.cumsum(mix(flat + _U(salt))))
                    upto = np.cumsum(sizes)
                    keys.append(sums[upto] - sums[upto - sizes])
                heads = [_prefix(s, frequent.value, num, den) if len(s) else s for s in sets]
                offsets = np.append(0, np.cumsum([len(x) for x in heads])).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _as_long(np.concatenate([np.zeros(0, _U), *heads])))
                wide = pa.array([bitmap(s).tobytes() if len(s) else b"" for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("r1"), part.column("r2"), _as_long(keys[0]), _as_long(keys[1]), pa.array(sizes, pa.int64()), listed, wide],
                    ["doc_id", "r1", "r2", "k1", "k2", "n", "prefix", "wide"],
                )

    return run


def _linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return len(a) > 0 and den * common >= num * (len(a) + len(b) - common)


def _verify(width: int, num: int, den: int):
    """Over rows by cell, texts before pairs: the pairs that link, but for those that links of the
    same cell already tie together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sets, root = None, {}, {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for part, own in texts_shingles(batch, "text", width):
                links = []
                rows = zip(*(part.column(c).to_pylist() for c in ("cell", "a", "b")), own, strict=True)
                for now, a, b, shingles in rows:
                    if now != cell:
                        cell, sets, root = now, {}, {}
                    if b is None:
                        sets[a] = shingles
                    elif find(a) != find(b) and _linked(sets[a], sets[b], num, den):
                        root[find(a)] = find(b)
                        links.append((a, b))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"]
                )

    return run


def _by_cell(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Rows (cell, a, b, column) sorted by cell: what `table` (cid, column) holds for the sets of the
    cell's pairs, then the pairs."""
    none = F.lit(None)
    nodes = pairs.select("cell", F.col("a").alias("cid")).unionByName(pairs.select("cell", F.col("b").alias("cid"))).distinct()
    held = nodes.join(table.select("cid", column), "cid").select("cell", F.col("cid").alias("a"), none.cast("long").alias("b"), column)
    kind = dict(table.dtypes)[column]
    rows = held.unionByName(pairs.select("cell", "a", "b", none.cast(kind).alias(column)))
    return rows.repartition("cell").sortWithinPartitions("cell", F.col("b").isNotNull())


def _texts(own: DataFrame, near: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, text) of the sets in the pairs `near`. Other texts go before anything is shuffled."""
    cids = near.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = stage(cids.join(classes.select("cid", "rep.r1", "rep.r2"), "cid"), "wanted")
    found = restrict(own.select("r1", "r2", "text"), wanted, ["r1", "r2"])
    texts = stage(found.join(wanted, ["r1", "r2"]).select("cid", "text"), "texts")
    if texts.count() > wanted.count():  # rows that repeat wholly
        texts = stage(texts.groupBy("cid").agg(F.first("text").alias("text")), "texts")
    return texts


def _links(
    pairs: DataFrame, own: DataFrame, classes: DataFrame, signs: DataFrame, width: int, num: int, den: int
) -> DataFrame:
    """The pairs (a, b, cell) whose texts link, enough of them to tie all that link."""
    asked = stage(pairs.groupBy("a", "b").agg(F.min("cell").alias("cell")), "asked")
    near = stage(_by_cell(asked, signs, "wide").mapInArrow(_screen(num, den), "a long, b long, cell long"), "near")
    return _by_cell(near, _texts(own, near, classes), "text").mapInArrow(_verify(width, num, den), "a long, b long")


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def _screen(num: int, den: int):
    """The pairs whose bitmaps, at the length of the shorter one, leave enough overlap possible."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for batch in batches:
            kept = []
            for now, a, b, wide in zip(*(batch.column(c).to_pylist() for c in ("cell", "a", "b", "wide")), strict=True):
                if now != cell:
                    cell, held = now, {}
                if b is None:
                    held[a] = (int.from_bytes(wide[:8], "little"), np.frombuffer(wide, _U, offset=8))
                    continue
                (n, x), (m, y) = held[a], held[b]
                words = min(len(x), len(y))
                x, y = _fold(x, words), _fold(y, words)
                spare = min(n - int(np.bitwise_count(x).sum()), m - int(np.bitwise_count(y).sum()))
                most = min(n, m, int(np.bitwise_count(x & y).sum()) + spare)
                if (num + den) * most >= num * (n + m):
                    kept.append((a, b, now))
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in range(3)], ["a", "b", "cell"])

    return run


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Token bitmap of at least _BITS and about four bits a token, a power of two."""
    size = max(_BITS, 1 << (4 * len(tokens)).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(mix(tokens) & _U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(_U)


def signature(wide: np.ndarray, n: int) -> np.ndarray:
    """The bitmap as the trees hold it: a large set has a longer one."""
    return _fold(wide, (_LARGE_BITS if n > _LARGE else _BITS) // 64)


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap as the trees hold it, and the whole one behind the set's size."""
    for batch in batches:
        sizes, bitmaps = batch.column("n").to_pylist(), batch.column("wide").to_pylist()
        bits = [signature(np.frombuffer(w, _U), n).tobytes() for w, n in zip(bitmaps, sizes, strict=True)]
        wide = [n.to_bytes(8, "little") + w for w, n in zip(bitmaps, sizes, strict=True)]
        columns = [batch.column("cid"), batch.column("n"), pa.array(bits, pa.binary()), pa.array(wide, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["cid", "n", "bits", "wide"])


class SignatureTree:
    """Levels of nodes over sets ordered by size; level 0 holds the sets themselves."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, label: np.ndarray, ratio: float):
        surplus = size - np.bitwise_count(bits).sum(1, dtype=np.int64)  # tokens that fell on a taken bit
        classes = np.floor(np.log(np.maximum(size, 1)) / -np.log(ratio))
        self.order = np.lexsort((size, bits[:, 0], classes))
        bits, size, surplus, label = bits[self.order], size[self.order], surplus[self.order], label[self.order]
        self.levels = [(bits, size, size, surplus, label, label)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, surplus, first, last = self.levels[-1]
            cuts = np.arange(0, len(bits), _FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cuts),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(surplus, cuts),
                    np.minimum.reduceat(first, cuts),
                    np.maximum.reduceat(last, cuts),
                )
            )


def _possible(one, x: np.ndarray, two, y: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets below nodes x and y of two levels can link and aren't all tied already."""
    bits_x, low_x, high_x, surplus_x, first_x, last_x = (v[x] for v in one)
    bits_y, low_y, high_y, surplus_y, first_y, last_y = (v[y] for v in two)
    shared = np.bitwise_count(bits_x & bits_y).sum(1, dtype=np.int64)
    most = np.minimum(np.minimum(high_x, high_y), shared + np.minimum(surplus_x, surplus_y))
    tied = (first_x == last_x) & (first_y == last_y) & (first_x == first_y)
    return ~tied & ((num + den) * most >= num * (low_x + low_y))


def dual_search(one: SignatureTree, two: SignatureTree | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets (places in the input) that may link: within one tree, or across two."""
    other = two or one
    depth = max(len(one.levels), len(other.levels)) - 1
    level = lambda tree, k: tree.levels[min(k, len(tree.levels) - 1)]
    found = []
    stack = [(depth, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        k, x, y = stack.pop()
        keep = _possible(level(one, k), x, level(other, k), y, num, den)
        x, y = x[keep], y[keep]
        if k == 0:
            if two is None:
                x, y = x[x < y], y[x < y]
            found.append((one.order[x], other.order[y]))
            continue
        wide_x, wide_y = k < len(one.levels), k < len(other.levels)
        for at in range(0, len(x), _PAIRS):
            p, q = x[at : at + _PAIRS], y[at : at + _PAIRS]
            for v in (0, 1):
                fan = (wide_x, wide_y)[v]
                if not fan:
                    continue
                n = len(level((one, other)[v], k - 1)[0])
                children = (p, q)[v][:, None] * _FANOUT + np.arange(_FANOUT)
                inside = children < n
                rest = np.broadcast_to((q, p)[v][:, None], children.shape)[inside]
                children = children[inside]
                p, q = (children, rest) if v == 0 else (rest, children)
            if two is None:
                p, q = p[p <= q], q[p <= q]
            stack.append((k - 1, p, q))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def candidates(
    n: np.ndarray, bits: list[np.ndarray], label: np.ndarray, side: np.ndarray | None, num: int, den: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that may link, within a group or (side 0 and 1) across two.

    Sets with short and with long bitmaps have trees of their own; between them the short length holds.
    """
    words = np.array([len(b) for b in bits])

    def tree(which: np.ndarray, length: int) -> SignatureTree | None:
        if not len(which):
            return None
        own = np.array([_fold(bits[i], length) for i in which], _U)
        return SignatureTree(n[which], own, label[which], num / den)

    found = []

    def search(one: np.ndarray, two: np.ndarray | None, length: int) -> None:
        x, y = tree(one, length), None if two is None else tree(two, length)
        if x is not None and (two is None or y is not None):
            a, b = dual_search(x, y, num, den)
            found.append((one[a], (one if two is None else two)[b]))

    kinds = np.unique(words)
    if side is None:
        for k, length in enumerate(kinds):
            search(np.flatnonzero(words == length), None, int(length))
            for longer in kinds[k + 1 :]:
                search(np.flatnonzero(words == length), np.flatnonzero(words == longer), int(length))
    else:
        for one in kinds:
            for two in kinds:
                search(np.flatnonzero((words == one) & (side == 0)), np.flatnonzero((words == two) & (side == 1)), int(min(one, two)))
    a, b = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
    return a, b


def _search(num: int, den: int, best_only: bool):
    """Candidate pairs of each cell; best_only: of each member only the likeliest, and a row with the
    bucket alone where that held pairs back."""

    def pairs(group: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, bool]:
        bits = [np.frombuffer(b, _U) for b in group["bits"]]
        own = group["cid"]
        side = None if group["x"][0] == group["y"][0] else group["side"]
        a, b = candidates(group["n"], bits, group["label"], side, num, den)
        held = False
        if best_only and len(a):
            short = np.array([_fold(x, _BITS // 64) for x in bits], _U)
            shared = np.bitwise_count(short[a] & short[b]).sum(1, dtype=np.int64)
            likely = shared / np.maximum(np.bitwise_count(short[a] | short[b]).sum(1, dtype=np.int64), 1)
            keep = np.zeros(len(a), bool)
            for end in (a, b):
                order = np.lexsort((-likely, end))
                keep[order[np.append(True, np.diff(end[order]) != 0)]] = True
            held = not keep.all()
            a, b = a[keep], b[keep]
        return np.minimum(own[a], own[b]), np.maximum(own[a], own[b]), held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def solve(table: pa.Table, upto: int) -> pa.RecordBatch:
            columns = {c: table.column(c).to_numpy() for c in ("h", "x", "y", "cell", "cid", "n", "label", "side")}
            columns["bits"] = np.array(table.column("bits").to_pylist() + [None], object)[:-1]
            edge = np.flatnonzero(
                np.append(True, (np.diff(columns["h"]) != 0) | (np.diff(columns["x"]) != 0) | (np.diff(columns["y"]) != 0))
            )
            edge = np.append(edge[edge < upto], upto)
            got = [pairs({c: v[i:j] for c, v in columns.items()}) for i, j in zip(edge[:-1], edge[1:], strict=True)]
            a, b = (np.concatenate([np.zeros(0, np.int64), *(g[k] for g in got)]) for k in (0, 1))
            cell = np.repeat(columns["cell"][edge[:-1]], [len(g[0]) for g in got])
            held = columns["h"][edge[:-1]][[g[2] for g in got]]
            full, none = np.zeros(len(a), bool), np.ones(len(held), bool)
            blank = np.zeros(len(held), np.int64)
            kept, bare = np.concatenate([full, none]), np.concatenate([~full, ~none])
            arrays = [
                pa.array(np.concatenate([v, blank]), mask=kept) for v in (a, b, cell)
            ] + [pa.array(np.concatenate([np.zeros(len(a), np.int64), held]), mask=bare)]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b", "cell", "h"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            last = table.num_rows - 1
            key = [table.column(c)[last].as_py() for c in ("h", "x", "y")]
            same = np.ones(table.num_rows, bool)
            for c, v in zip(("h", "x", "y"), key, strict=True):
                same &= table.column(c).to_numpy() == v
            upto = int(np.argmax(same))
            if upto:
                yield solve(table, upto)
            rest = table.slice(upto)
        if rest is not None and rest.num_rows:
            yield solve(rest, rest.num_rows)

    return run


def _tree_search(members: DataFrame, signs: DataFrame, num: int, den: int, best_only: bool) -> DataFrame:
    """Candidate pairs (a, b, cell), and with best_only rows (h), of members (h, cid, blocks, label)."""
    rows = members.join(signs.drop("wide"), "cid")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x, y = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.select(
        "h", x.alias("x"), y.alias("y"), F.xxhash64("h", x, y).alias("cell"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "cid", "label", "n", "bits",
    )
    dealt = rows.repartition("h", "x", "y").sortWithinPartitions("h", "x", "y")
    return dealt.mapInArrow(_search(num, den, best_only), "a long, b long, cell long, h long")


def link_documents(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept, r1, r2.

    Two rows link when den * |A and B| >= num * |A or B| over their sets of distinct `width`-word
    shingles; A-Z are folded, words are runs of anything but white space. A text of fewer words has
    one shingle; a null text, or one without words, has none and links with nothing.
    component_id is the smallest doc_id in reach (a null only where all are null). `kept` marks
    the rows of one document of each component; rows that repeat it wholly (r1 and r2 agree, hashes
    of doc_id and text) are marked too. Other columns are ignored.
    """
    with shuffles_freed(docs.sparkSession):
        return _link(docs, width, num, den)


def _link(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    spark = docs.sparkSession
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    own = own.select("doc_id", "text", *row_keys("doc_id", "text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(own, width))
    prints = own.mapInArrow(
        _fingerprint(width, num, den, frequent),
        "doc_id long, r1 long, r2 long, k1 long, k2 long, n long, prefix array<long>, wide binary",
    )
    prints = stage(prints.withColumn("cid", F.monotonically_increasing_id()), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2", "cid"))
    classes = prints.where("n > 0").groupBy("k1", "k2", "n").agg(first.alias("rep"))
    classes = stage(classes.withColumn("cid", F.col("rep.cid")), "classes")

    tokens = prints.join(classes.select("cid"), "cid").select("cid", F.explode("prefix").alias("h"))
    shared = tokens.groupBy("h").agg(F.min("cid").alias("low"), F.max("cid").alias("top")).where("low < top")
    shared = stage(shared.select("h"), "shared")
    postings = stage(tokens.join(shared, "h"), "postings")
    wanted = postings.select("cid").distinct()
    signs = prints.select("cid", "n", "wide").join(wanted, "cid").mapInArrow(_sign, "cid long, n long, bits binary, wide binary")
    signs = stage(signs, "signs")

    # Buckets with the same members need one search.
    counted = postings.groupBy("h").agg(
        F.count("*").alias("count"),
        F.bit_xor(F.xxhash64("cid")).alias("d1"),
        F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("d2"),
    )
    buckets = counted.groupBy("count", "d1", "d2").agg(F.min("h").alias("h"))
    buckets = buckets.select("h", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    chosen = stage(postings.join(buckets, "h"), "chosen")

    found = stage(_tree_search(chosen.withColumn("label", F.col("cid")), signs, num, den, True), "found")
    links = stage(_links(found.where("a IS NOT NULL").drop("h"), own, classes, signs, width, num, den), "links")
    tied = stage(components(links).withColumnRenamed("id", "cid"), "tied")

    rest = chosen.join(found.where("a IS NULL").select("h").distinct(), "h", "left_semi").join(tied, "cid", "left")
    rest = stage(rest.withColumn("label", F.coalesce("root", "cid")).drop("root"), "rest")
    mixed = rest.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    more = _tree_search(rest.join(mixed.select("h"), "h"), signs, num, den, False).drop("h")
    late = stage(_links(more, own, classes, signs, width, num, den), "links")

    whole = components(links.unionByName(late)).withColumnRenamed("id", "cid")
    rooted = classes.select("cid", "k1", "k2", "rep").join(whole, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    heads = rooted.groupBy("root").agg(F.min("rep").alias("head"))
    map_ = rooted.join(heads, "root").select("k1", "k2", "head")
    alone = prints.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "r1", "r2"
    )
    linked = prints.where("n > 0").join(map_, ["k1", "k2"]).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("head.doc_id").alias("component_id"),
        ((F.col("r1") == F.col("head.r1")) & (F.col("r2") == F.col("head.r2"))).alias("kept"),
        "r1",
        "r2",
    )
    return linked.unionByName(alone)


def row_keys(*columns: str) -> list:
    """Two 64-bit hashes that together stand for a row."""
    return [
        F.xxhash64(*columns).alias("r1"),
        F.xxhash64(*reversed(columns), F.lit(1)).alias("r2"),
    ]


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents with one of each component kept, all their columns as they are.

    Rows that repeat a kept document wholly in doc_id and text are dropped too; texts without words
    link with nothing and all stay.
    """
    found = settle(docs.sparkSession, lambda: link_documents(docs, width, num, den), "linked")
    wordless = found.where("n_shingles = 0").select("r1", "r2").distinct().withColumn("all", F.lit(True))
    chosen = found.where("n_shingles > 0 AND kept").select("r1", "r2").distinct().withColumn("all", F.lit(False))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    r1, r2 = (
        F.xxhash64(F.col("doc_id").cast("long"), text),
        F.xxhash64(text, F.col("doc_id").cast("long"), F.lit(1)),
    )
    # All columns as one, so that no name can clash.
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"), r1.alias("r1"), r2.alias("r2"))
    rows = stage(rows.join(chosen.unionByName(wordless), ["r1", "r2"]), "kept")
    once = rows.where("NOT all")
    if once.count() > once.select("r1", "r2").distinct().count():
        once = once.dropDuplicates(["r1", "r2"])
    return once.select("record.*").unionByName(rows.where("all").select("record.*"))
