"""Jaccard join, components and line dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import jaccard_join, line_dedup
from holdfast.llm.components import components
from holdfast.sources import tables


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (500, 500)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + edges[:5]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == closure({n for e in real for n in e}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def corpus(seed=4, n_bases=25):
    """Bases, copies with edits of several strengths, a shared passage, odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(30)]
    rows, number = [], 0
    for _ in range(n_bases):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(1, 6)):
            copy = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.03]) else w for w in base]
            if rng.random() < 0.3:
                copy += passage
            rows.append((number, " ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy)))
            number += 1
    rows += [(number, None), (number + 1, ""), (number + 2, " \n"), (number + 3, "two words"), (number + 4, "Two\twords")]
    rows += [rows[3], rows[3], (None, rows[0][1]), (None, "only here without id"), (number + 5, "long " * 30000)]
    return rows


def shingled(value, width):
    words = (value or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, min(1, len(words))))}


def brute(rows, width, num, den):
    sets = [shingled(t, width) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    roots = closure(range(len(rows)), links)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[roots[i]] = min(ids.get(roots[i], doc_id), doc_id)
    return sorted(((d, len(s), ids.get(roots[i])) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr), roots


@pytest.mark.parametrize(("width", "num", "block"), [(4, 85, 512), (5, 80, 3)])
def test_join_equals_brute_force(spark, monkeypatch, width, num, block):
    """Blocks of three members make every larger bucket cross cells."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("cid", F.lit(1))
    got = jaccard_join.link_documents(docs, width, num, 100).collect()
    want, roots = brute(rows, width, num, 100)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want

    kept = jaccard_join.keep_one(docs, width, num, 100)
    assert kept.columns == docs.columns
    with_words = [i for i, (_, t) in enumerate(rows) if (t or "").split()]
    without = len(rows) - len(with_words)
    assert kept.count() == len({roots[i] for i in with_words}) + without


def test_join_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert jaccard_join.link_documents(none).count() == 0
    assert jaccard_join.keep_one(none).count() == 0


def test_dual_search_drops_no_pair_that_links():
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 1 << 62, 4000).astype(np.uint64)
    sets = []
    for _ in range(60):
        base = rng.choice(pool, rng.choice([rng.integers(1, 400), rng.integers(1450, 1600)]), replace=False)
        for _ in range(3):
            keep = base[rng.random(len(base)) > 0.05]
            sets.append(np.unique(np.concatenate([keep, rng.choice(pool, 3)])))
    bits = [jaccard_join.signature(jaccard_join.bitmap(x), len(x)) for x in sets]
    size = np.array([len(x) for x in sets])
    labels = np.arange(len(sets))
    a, b = jaccard_join.candidates(size, bits, labels, None, 80, 100)
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
    true = {
        frozenset((i, j))
        for i in range(len(sets))
        for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    assert true and true <= found and len(found) < len(sets) ** 2 / 4
    assert {len(x) for x in bits} == {32, 128}  # short and long bitmaps met
    side = np.arange(len(sets)) % 2
    a, b = jaccard_join.candidates(size, bits, labels, side, 80, 100)
    assert not side[a].any() and side[b].all()
    across = {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert {p for p in true if len({int(side[i]) for i in p}) == 2} <= across
    tied = np.zeros(len(sets), np.int64)
    assert len(jaccard_join.candidates(size, bits, tied, None, 80, 100)[0]) == 0


def test_line_dedup_keeps_the_first_of_each_component(spark):
    line = "The quick brown fox jumps over the lazy dog near the river bank today"
    rows = [
        (1, f"{line}\nunique line number one\n\nshort"),
        (2, f"{line}!\nanother one entirely different\n\nshort"),
        (3, line.replace("today", "toda") + "\nab\nab\n世界"),
        (None, f"{line}\nnull id line of its own"),
        (4, None),
        (5, ""),
        (5, ""),
        (6, "x" * 30000 + "\n" + "x" * 30001),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    got = {(r["doc_id"], r["n_lines"]): (list(r["dropped"]), r["copies"]) for r in line_dedup.line_decisions(docs).collect()}
    assert got == {
        (1, 4): ([], 1), (2, 4): ([0, 3], 1), (3, 4): ([0, 2], 1), (None, 2): ([0], 1), (4, 1): ([], 1), (5, 1): ([], 2),
        (6, 2): ([1], 1),
    }
    texts = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert texts[2] == "another one entirely different\n"
    assert texts[1] == rows[0][1] and texts[4] is None
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns
    assert line_dedup.line_decisions(docs.limit(0)).count() == 0


def test_line_dedup_holds_the_disk_of_one_step(spark):
    """Bands, pairs and links are deleted when the components are known; shuffle files go with their step."""
    import os
    import time

    def shuffle_files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = manager.getAllFiles().mkString("\n").split("\n")
        return {n for n in names if n.rsplit("/", 1)[-1].startswith("shuffle_")}

    rows = [(i, f"some words of line {i % 7} that many texts share\nown {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = shuffle_files()
    with tables.staging(spark) as folder:
        found = line_dedup.line_decisions(docs)
        at = folder.removeprefix("file:")
        assert {name for run in os.listdir(at) for name in os.listdir(f"{at}/{run}")} == {"lines", "tied"}
        for _ in range(50):
            if not shuffle_files() - before:
                break
            time.sleep(0.2)
        assert not shuffle_files() - before
        assert found.count() == 30


def test_line_dedup_links_what_brute_force_links(spark):
    """Every line pair that is dropped is tied by true links; nearly all true links are found."""
    rng = random.Random(9)
    words = [f"term{i}" for i in range(80)]
    lines = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(12)]
        lines.append(" ".join(base))
        lines += [" ".join(base[:k] + [rng.choice(words)] + base[k + 1 :]) for k in range(2)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    dropped = {r["doc_id"] for r in line_dedup.line_decisions(docs).collect() if r["n_dropped"]}

    def grams(s):
        return {s[i : i + 5] for i in range(len(s) - 4)}

    sets = [grams(s) for s in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    roots = closure(range(len(lines)), links)
    true = {i for i in roots if roots[i] != i}
    assert dropped <= true and len(dropped) >= 0.95 * len(true)


def dropped_and_true(spark, lines, width=7):
    """Lines that line dedup drops, and those that all true links tie to an earlier one."""
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    dropped = {r["doc_id"] for r in line_dedup.line_decisions(docs).collect() if r["n_dropped"]}
    sets = [{s[i : i + width] for i in range(len(s) - width + 1)} for s in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return dropped, {i for i, root in closure(range(len(lines)), links).items() if root != i}


def test_line_dedup_links_lines_of_38_to_60_words(spark):
    """Copies that miss a word or two, most of them shorter than a length that the first has."""
    rng = random.Random(12)
    words = [f"term{i}" for i in range(400)]
    lines = []
    for n in [42, 41, 40] * 20 + list(range(38, 61)):
        base = [rng.choice(words) for _ in range(n)]
        lines.append(" ".join(base))
        for gone in (1, 2):
            left = sorted(rng.sample(range(n), n - gone))
            lines.append(" ".join(base[k] for k in left))
    dropped, true = dropped_and_true(spark, lines)
    assert dropped <= true and len(dropped) >= 0.97 * len(true)


def test_line_dedup_compares_all_lines_that_meet_in_a_band(spark, monkeypatch):
    """A family of one template, whose bands hold many lines that neither of their ends ties."""
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    rng = random.Random(21)
    words = [f"word{i}" for i in range(500)]

    def edited(base, n):
        places = set(rng.sample(range(len(base)), n))
        return [rng.choice(words) if k in places else w for k, w in enumerate(base)]

    template = [rng.choice(words) for _ in range(60)]
    variants = [edited(template, 11) for _ in range(150)]
    lines = [" ".join(edited(v, rng.choice((0, 1, 2)))) for v in variants for _ in range(4)]
    rng.shuffle(lines)
    lines = list(dict.fromkeys(lines))
    table = spark.createDataFrame(list(enumerate(lines)), "lid long, line string")
    meet = {}
    for r in line_dedup.band_keys(table, 7).collect():
        meet.setdefault(r["band"], []).append(r["lid"])
    assert max(map(len, meet.values())) > 3 * line_dedup.BLOCK
    sets = [{s[i : i + 7] for i in range(len(s) - 6)} for s in lines]
    pairs = {(i, j) for own in meet.values() for i in own for j in own if i < j}
    links = [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = {i for i, root in closure(range(len(lines)), links).items() if root != i}
    dropped, true = dropped_and_true(spark, lines)
    assert len(want) >= 0.97 * len(true)
    assert dropped == want


def test_line_shingles_are_rows_without_lambdas(spark):
    """Hashed by compiled code, across blocks of lines, in and beyond ASCII; every shingle meets as in a whole set."""
    start = line_dedup._STARTS
    base = "abcdefghij klmnopqrst uvwxyz 0123456789 " * 4
    lines = [base[:n] for n in (1, 6, 7, 8, start, start + 5, start + 6, start + 7, 2 * start, 2 * start + 6, 2 * start + 7, 150)]
    lines += [line.replace("k", "é").replace("q", "世").replace("b", "𝄞") for line in lines] + [" \t\r", "x\r y zzzzzzzzzzz"]
    table = spark.createDataFrame(list(enumerate(lines)), "lid long, line string").coalesce(1)
    rows = line_dedup.shingle_rows(table, 7)
    assert "lambda" not in line_dedup.band_keys(table, 7)._jdf.queryExecution().optimizedPlan().toString()
    runs = [[s[i : i + 7] for i in range(max(len(s) - 6, 1))] for s in lines]
    flat = spark.createDataFrame([(i, r) for i, own in enumerate(runs) for r in own], "lid long, run string")
    want = sorted(map(tuple, flat.select("lid", F.xxhash64("run")).collect()))
    assert sorted(map(tuple, rows.collect())) == want
    arrays = table.select("lid", F.explode(line_dedup.shingles(F.col("line"), 7)))
    assert sorted(map(tuple, arrays.collect())) == want


def test_line_sketches_rule_out_lines_that_do_not_link(spark):
    """Variants of a template at similarities of 0.5 to 0.9: no link is lost, few others are left."""
    rng = random.Random(31)
    template = "".join(rng.choice("abcdefghijklmnop ") for _ in range(330))
    lines = [template]
    for n in range(60):
        at = set(rng.sample(range(330), n // 3 + 1))
        lines.append("".join("Z" if k in at else c for k, c in enumerate(template)))
    table = spark.createDataFrame(list(enumerate(lines)), "lid long, line string")
    banded = spark.createDataFrame([(1, i) for i in range(len(lines))], "band long, lid long")
    ends = spark.createDataFrame([(1, -1, -2, len(lines))], "band long, low long, high long, members long")
    tied = spark.createDataFrame([], "lid long, root long")
    found = {(r["a"], r["b"]) for r in line_dedup._rest(table, banded, ends, tied, 7, 80, 100).collect()}
    sets = [{s[i : i + 7] for i in range(len(s) - 6)} for s in lines]
    pairs = [(i, j) for j in range(len(lines)) for i in range(j)]
    links = {(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert links and links <= found
    assert len(found - links) <= 0.05 * (len(pairs) - len(links))


def test_line_bands_are_shuffled_once(spark):
    """The lines that meet with the ends of their bands: the bands are dealt out once for both."""
    rows = [(i, i % 5) for i in range(40)] + [(i, 100 + i) for i in range(40)]
    met = line_dedup._meetings(spark.createDataFrame(rows, "lid long, band long"))
    got = sorted(map(tuple, met.collect()))
    assert got == sorted((i % 5, i, i % 5, i % 5 + 35, 8) for i in range(40))
    plan = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    dealt = [line for line in plan.split("\n") if "Exchange" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1 and len(dealt) == 2


def test_line_dedup_joins_only_places_of_repeated_lines(spark):
    """Lines that repeat, are tied, are both, or stand alone; rows that repeat wholly and null ids."""
    base = "The quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(3, f"{base}\nalone in the third\nrepeated"), (1, f"{base}!\nrepeated\nrepeated"), (2, f"{base}\nalone in the second")]
    rows += [(3, rows[0][1]), (None, "repeated\nof the null id"), (None, f"{base}?"), (4, "no line of others\n\n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.line_decisions(docs)
    got = sorted((r["doc_id"] or 0, r["n_lines"], r["copies"], list(r["dropped"])) for r in found.collect())
    assert got == [(0, 1, 1, [0]), (0, 2, 1, [0]), (1, 3, 1, [2]), (2, 2, 1, [0]), (3, 3, 2, [0, 2]), (4, 3, 1, [])]
    with tables.staging(spark) as folder:
        line_dedup.line_decisions(docs)
        import glob

        lines = spark.read.parquet(*glob.glob(folder.removeprefix("file:") + "/*/lines"))
        assert {r["places"] for r in lines.collect()} == {1, 2, 3, 5}


def test_line_bands_are_grouped_by_one_number(spark):
    """Bands are those of (line, band number) grouped by hand; ids are as large as `monotonically_increasing_id` makes them."""
    ids = [0, 1, 7, 8, (1 << 33) + 5, (5000 << 33) + 3]
    texts = ["short", "seven c", "the quick brown fox jumps over the lazy dog " * 3, "fa\u00e7ade \u00fcber \u6f22\u5b57 \U0001f600 " * 9, "a" * 60, "x y z " * 40]
    table = spark.createDataFrame(list(zip(ids, texts, strict=True)), "lid long, line string")
    least = {}
    for r in line_dedup.shingle_rows(table, 7).collect():
        h = r["h"] & ((1 << 64) - 1)
        bins = least.setdefault((r["lid"], h >> 61), [None] * 4)
        k, rest = (h >> 59) & 3, (h >> 28) & ((1 << 31) - 1)
        bins[k] = rest if bins[k] is None else min(bins[k], rest)
    rows = [(lid, n, *(-1 if m is None else m for m in bins)) for (lid, n), bins in least.items()]
    wanted = spark.createDataFrame(rows, "lid long, n int, m0 int, m1 int, m2 int, m3 int")
    wanted = wanted.select("lid", F.xxhash64("n", "m0", "m1", "m2", "m3").alias("band"))
    found = line_dedup.band_keys(table, 7)
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    (dealt,) = [line for line in plan.split("\n") if "Exchange" in line]
    assert "hashpartitioning(slot#" in dealt
