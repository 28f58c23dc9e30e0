"""Records, archives, ledger, mix, leaks, quality, neighbours, secrets and the pipeline on small tables."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import decontaminate, mixing, quality, records, rp_forest, secrets, token_counts, warc
from holdfast.sources.tables import scratch_path

BPE = tokenizer_path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [
        (3, "The cat sat.\nThe cat ran.", "en", "a", 10),
        (1, "", "de", None, 0),
        (2, None, None, "b", None),
        (None, "no number", "en", "b", 9),
        (7, "Größe 世界 don't " * 3, "de", "a", 5),
        (7, "Größe 世界 don't " * 3, "de", "a", 5),
        (9, "a very long text " * 60000, "en", "c", 1),
        (7, "another text of the same id", "de", "c", 5),
    ]
    return spark.createDataFrame(rows, DOCS)


# --- records ----------------------------------------------------------------------


def test_records_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    docs = odd_documents(spark).withColumn("file", F.lit("clash")).withColumn("start", F.lit("x"))
    folder = scratch_path(spark, "round_trip")
    got = records.token_records(docs, BPE, 2, folder).collect()
    want = [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]
    keyed = sorted((d is not None, d or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want)
    assert keyed == sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] if r["doc_id"] is not None else -1 for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    index = spark.read.parquet(f"{folder}/index")
    some = records.read_records(f"{folder}/data", index.where("doc_id = 7")).collect()
    assert sorted(list(r["ids"]) for r in some) == sorted(ids for d, ids in want if d == 7)
    assert records.token_records(docs.limit(0), BPE, 2).count() == 0


def test_over_a_thousand_files_of_a_task_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(records, "RECORDS_PER_FILE", 1)
    docs = spark.range(1100).select(F.col("id").alias("doc_id"), F.lit("word").alias("text")).coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "1")
    try:
        got = records.token_records(docs, BPE, 2).orderBy("start").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert any("-c1000" in r["file"] for r in got)
    assert [r["doc_id"] for r in got] == list(range(1100))
    assert [r["start"] for r in got] == [2 * k for k in range(1100)]


def test_damaged_records_are_refused():
    good = records.frame(5, np.array([1, 2, 3], "<u2")) + records.END
    number, ids, stop = records.parse(good)
    assert (number, list(ids), stop) == (5, [1, 2, 3], len(good))
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.parse(bytes(bad))
    with pytest.raises(ValueError):
        records.parse(good[:10])


# --- archives ---------------------------------------------------------------------


def test_archives_round_trip_in_segments(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 64)
    monkeypatch.setattr(warc, "CHUNKS_PER_FILE", 3)
    long = "é世 \r\n\r\nWARC/1.1 " * 40
    rows = [(5, "u", long), (2, "a b\r\nX: y", long), (9, None, ""), (8, "u", None), (4, "u", "x"), (None, "u", "x"), (6, "u", "own"), (None, "n", "nowhere"), (2, "u", "twice"), (2, "u", "twice")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit("clash"))

    def expected(min_bytes):
        payloads = [(p, (h or "").encode()) for p, _, h in rows]
        out = []
        for p, body in payloads:
            ids = [q for q, other in payloads if other == body and q is not None]
            first = min(ids, default=None)
            response = len(body) < min_bytes or p == first
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            out.append((p, len(body), digest, "response" if response else "revisit", None if response else first))
        return sorted(out, key=repr)

    for least, hot in ((0, 1000), (4, 1000), (0, 1), (4, 1)):
        monkeypatch.setattr(warc, "HOT_ROWS", hot)
        got = [tuple(r) for r in warc.archive_pages(pages, least).collect()]
        assert sorted(got, key=repr) == expected(least)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_archive_ids_are_unique_stable_and_resolved(spark, tmp_path):
    """Read by Python's own gzip: ids differ, do not change with another run, and each reference has its response."""
    rows = [(i, "u", "x" * (i % 7)) for i in range(60)] + [(3, "u", "xxx")] * 3 + [(None, "u", "only none")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for run, parts in enumerate((1, 5)):
        warc.write_archives(pages.repartition(parts), f"{tmp_path}/{run}")
        text = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(tmp_path.glob(f"{run}/part-*"))).decode()
        ids = re.findall(r"WARC-Record-ID: <(.*)>\r", text)
        kinds = re.findall(r"WARC-Type: (.*)\r", text)
        responses = {i for i, kind in zip(ids, kinds, strict=True) if kind == "response"}
        assert len(ids) == len(set(ids)) == len(rows)
        assert set(re.findall(r"WARC-Refers-To: <(.*)>\r", text)) <= responses
        found.append(set(ids))
    assert found[0] == found[1]


def test_gzip_members_are_read_one_by_one(monkeypatch):
    one, two = b"a" * 50_000, bytes(range(256)) * 200
    data = gzip.compress(one) + warc.EMPTY + warc.EMPTY + gzip.compress(two) + warc.EMPTY
    assert list(warc._members(memoryview(data))) == [one, two]
    with pytest.raises(ValueError):
        list(warc._members(memoryview(data[:-30])))
    monkeypatch.setattr(warc, "CHUNK", 1000)
    monkeypatch.setattr(warc, "HEAD", 1000)
    with pytest.raises(ValueError):
        list(warc._members(memoryview(data)))


# --- ledger -----------------------------------------------------------------------


def test_ledger_counts_retries_once(spark):
    ledger = token_counts.Ledger(spark, scratch_path(spark, "ledger"))

    def changes(*rows):
        return spark.createDataFrame(rows, token_counts.CHANGE)

    def totals():
        return {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in ledger.totals().collect()}

    first = changes(
        ("insert", 0, 1, "t", "s", "en", 10), ("insert", 0, 2, "t", "s", "en", 5), ("insert", 0, 3, "t", None, None, 7),
        ("insert", 0, None, "t", "s", "en", 99), ("nonsense", 0, 4, "t", "s", "en", 99), ("insert", 0, 2, "u", "s", "en", 4),
        ("insert", 0, 1, "t", "s", "en", 10),
    )
    assert ledger.totals().count() == 0
    assert ledger.commit(1, first) and not ledger.commit(1, first)
    assert totals() == {("s", "en", "t"): (2, 15), (None, None, "t"): (1, 7), ("s", "en", "u"): (1, 4)}
    second = changes(
        ("revise", 1, 1, "t", "s", "de", 12), ("delete", 1, 3, "t", None, None, None), ("delete", 1, 8, "t", "s", "en", 1),
        ("insert", 1, 2, "t", "s", "en", 6), ("revise", 2, 2, "t", "s", "en", 8),
    )
    # A batch that broke before its commit row is not seen, and is replaced when it is retried.
    first.limit(0).select("source").write.mode("overwrite").parquet(f"{ledger.path}/state/batch=2")
    assert ledger.committed() == [0, 1] or ledger.committed() == [1]
    assert ledger.commit(2, second) and not ledger.commit(2, second)
    assert totals() == {("s", "en", "t"): (1, 8), ("s", "de", "t"): (1, 12), ("s", "en", "u"): (1, 4)}
    assert ledger.commit(3, second.limit(0))
    with pytest.raises(ValueError):
        token_counts.Ledger(spark, ledger.path).commit(0, second)


def test_corpus_totals_of_odd_documents(spark):
    """Every row counts: without a doc_id, with one that repeats, and whole rows that repeat."""
    docs = odd_documents(spark).unionByName(
        spark.createDataFrame([(None, "no number", "en", "b", 9), (4, "no number", None, "en", 9), (4, "two", "en", None, 9), (4, "two", None, "en", 9)], DOCS)
    )
    docs = docs.withColumn("record", F.lit("clash")).withColumn("tokens", F.lit(1))
    rows = [(r["doc_id"], r["text"] or "", r["source"], r["lang"]) for r in docs.collect()]
    want = {}
    for doc_id, text, source, lang in rows:
        if doc_id == min((d for d, t, *_ in rows if t == text and d is not None), default=None):
            at = want.setdefault((source, lang), [0, 0])
            at[0], at[1] = at[0] + 1, at[1] + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    for hot in (1000, 1):
        token_counts.HOT_ROWS = hot
        found = token_counts.corpus_totals(docs, scratch_path(spark, "ledger"), token_counts.WORDS_1).collect()
        assert {(r["source"], r["lang"]): [r["docs"], r["tokens"]] for r in found} == want
    token_counts.HOT_ROWS = 1000
    assert token_counts.corpus_totals(docs.limit(0), scratch_path(spark, "ledger")).count() == 0


def test_compaction_changes_no_total(spark, monkeypatch):
    """Random batches against a dictionary, compacted on the way, killed before its marker, vacuumed, and retried."""
    monkeypatch.setattr(token_counts, "BUCKETS", 4)
    monkeypatch.setattr(token_counts, "COMPACT_EVERY", 3)
    rng, held = random.Random(5), {}
    ledger = token_counts.Ledger(spark, scratch_path(spark, "ledger"))

    def totals():
        return {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in ledger.totals().collect()}

    def expected():
        out = {}
        for source, tokens in held.values():
            docs, sums = out.get((source, "en", "t"), (0, 0))
            out[source, "en", "t"] = (docs + 1, sums + tokens)
        return out

    batches = {}
    for batch in range(1, 6):
        rows = []
        for doc in rng.sample(range(12), 5):
            op, source, tokens = rng.choice(["insert", "revise", "delete"]), rng.choice("ab"), rng.randint(0, 9)
            rows.append((op, 0, doc, "t", source, "en", tokens))
            held.pop(doc, None)
            if op != "delete":
                held[doc] = (source, tokens)
        batches[batch] = spark.createDataFrame(rows, token_counts.CHANGE)
        assert ledger.commit(batch, batches[batch]) and not ledger.commit(batch, batches[batch])
        assert totals() == expected()
    assert ledger.through() == 3 and ledger.committed() == [4, 5]

    # A compaction that ends before its marker isn't seen, and is made again.
    with monkeypatch.context() as m:
        m.setattr(token_counts.Ledger, "_sums", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.compact()
    assert ledger.through() == 3 and totals() == expected()
    assert ledger.compact() == 5 and ledger.compact() == 5 and ledger.committed() == []
    ledger.vacuum()
    assert totals() == expected()
    assert not any(ledger.commit(b, batches[b]) for b in batches)
    assert ledger._state(5, []).count() == len(held)
    with pytest.raises(ValueError):
        ledger.commit(0, batches[1])
    assert ledger.commit(9, batches[1].limit(0)) and totals() == expected()


# --- mix --------------------------------------------------------------------------


def mix_corpus(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), "en", "big" if i % 10 < 6 else f"s{i % 4}", 1) for i in range(600)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("target", [mixing.Target(), mixing.Target(0.97, 3.0, None, 500), mixing.Target(0.9, 4.0, 4000, 700)])
def test_mix_meets_its_target(spark, target):
    docs = mix_corpus(spark)
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split()) + 1
    total = sum(sizes.values())
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, n long")
    exponent = mixing.find_exponent(table, target)

    def met(a):
        weights = {s: (n / total) ** a for s, n in sizes.items()}
        z = sum(weights.values())
        entropy = -sum(w / z * math.log(w / z) for w in weights.values())
        ratios = [w / z / (sizes[s] / total) for s, w in weights.items()]
        repeats = max(ratios) / min(ratios) if target.budget is None else max(ratios) * target.budget / total
        return entropy <= target.evenness * math.log(len(sizes)) + 1e-9 and repeats <= target.max_repeats * (1 + 1e-6)

    assert met(exponent) and (exponent == 0 or not met(exponent - 1e-6))
    drawn = mixing.mix_sources(docs, target).collect()
    if target.budget is None:
        assert {r["doc_id"] for r in drawn} == set(range(600))
    longest = 41
    used = {}
    for r in drawn:
        used[r["source"]] = used.get(r["source"], 0) + r["tokens"]
    z = sum((n / total) ** exponent for n in sizes.values())
    size = target.budget or max(sizes[s] / ((sizes[s] / total) ** exponent / z) for s in sizes)
    for s, n in sizes.items():
        assert abs(used[s] - size * (n / total) ** exponent / z) <= longest
    # A document is drawn once an epoch, and a source's epochs fill one after the other.
    assert len({(r["doc_id"], r["epoch"]) for r in drawn}) == len(drawn)
    for s in sizes:
        positions = sorted((r["position"], r["epoch"], r["tokens"]) for r in drawn if r["source"] == s)
        at = 0
        for position, _, tokens in positions:
            assert position == at
            at += tokens
        assert [e for _, e, _ in positions] == sorted(e for _, e, _ in positions)
    assert {r["block"] for r in drawn} == set(range(max(r["block"] for r in drawn) + 1))


def test_mix_of_odd_documents(spark):
    docs = odd_documents(spark).withColumn("tokens", F.lit("clash")).withColumn("epoch", F.lit(1))
    out = mixing.mixed_documents(docs, mixing.Target())
    assert out.columns == docs.columns
    assert set(map(tuple, out.collect())) == set(map(tuple, docs.collect()))
    assert mixing.mixed_documents(docs.limit(0), mixing.Target()).count() == 0
    assert mixing.mix_sources(docs.limit(0), mixing.Target(budget=100)).count() == 0


# --- leaks ------------------------------------------------------------------------


def leaks_by_hand(docs, items, width):
    def words(value):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))

    out = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for item, other in items:
            other = words(other)
            size = min(width, len(other))
            windows = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if size else set()
            for i in range(len(own) - size + 1) if size else ():
                if tuple(own[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    names.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("item_bytes", [1 << 22, 400])
def test_leaks_equal_brute_force(spark, monkeypatch, item_bytes):
    """Small broadcasts split the benchmark into several searches."""
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", item_bytes)
    rng = random.Random(8)
    words = ["alpha", "Beta", "gamma", "delta", "é", "x9"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(40)]
    items += [(40, None), (41, "..."), (None, "zeta eta theta"), (3, "second text of item three here")]
    docs = [(i, ", ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, items[5][1]), (102, items[5][1]), (None, "zeta, ETA! theta"), (103, "alpha " * 5000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash")).withColumn("item", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(table, benchmark, 5)
    got = [(r["doc_id"], *(r[c] for c in decontaminate.RESULTS)) for r in found.collect()]
    assert sorted(got, key=repr) == leaks_by_hand(docs, items, 5)
    clean = decontaminate.find_leaks(table, benchmark.limit(0))
    assert clean.where("contaminated").count() == 0 and clean.count() == len(docs)
    assert decontaminate.find_leaks(table.limit(0), benchmark).count() == 0


# --- quality ----------------------------------------------------------------------


def test_model_learns_main_effects_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) * 0.8 + (x[:, 2] > 0.7) * 0.6 > rng.random(6000)
    model = quality.fit(x[:4000], y[:4000].astype(float), rounds=60)
    assert (0, 1) in model.pairs
    right = (model.scores(x[4000:]) > 0.5) == y[4000:]
    assert right.mean() > 0.75
    flat = quality.fit(np.zeros((0, 5)), np.zeros(0))
    assert flat.scores(x[:3]).tolist() == [0.5] * 3
    assert (quality.fit(x[:50], np.ones(50)).scores(x) > 0.9).all()


def test_quality_of_planted_junk(spark):
    rng = random.Random(6)
    good = "the of and to in river mountain season letter garden window teacher morning".split()
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [rng.choice(good) for _ in range(rng.randrange(20, 80))]
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words).capitalize() + "."
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd_documents(spark)).withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0), (99999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, marks).collect()
    assert len(got) == 608
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    truth = {i: q for i, q, _ in labels}
    planted = [r for r in held if r["source"] == "s"]
    assert len(planted) > 50 and all(r["predicted"] == truth[r["doc_id"]] for r in planted)
    assert all(0 <= r["score"] <= 1 for r in got)
    none = quality.score_quality(docs, marks.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), marks).count() == 0


# --- neighbours -------------------------------------------------------------------


def test_neighbours_are_exact_distances_and_mostly_the_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:140] = x[0]  # more copies than neighbours
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(5000, None, 0), (5100, [0.0] * 16, 0), (5200, [float("nan")] + [1.0] * 15, 0), (5300, [float("inf")] * 16, 0)]
    rows += [(5400, [None] + [1.0] * 15, 0), (None, [1.0] * 16, 0), (5500, [1.0] * 3, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("leaf", F.lit("clash"))
    got = rp_forest.nearest_neighbours(table, search=4000).collect()
    wide = x.astype(np.float64)
    hits = total = 0
    for query in range(0, 3000, 100):
        own = sorted((r for r in got if r["query_id"] == query), key=lambda r: r["rank"])
        distance = np.sqrt(((wide - wide[query]) ** 2).sum(1))
        distance[query] = np.inf
        best = np.lexsort((np.arange(3000), distance))[:10]
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in own] == sorted((r["score"], r["vec_id"]) for r in own)
        for r in own:
            assert r["score"] == pytest.approx(distance[r["vec_id"]], rel=1e-12)
        hits += len(set(best.tolist()) & {r["vec_id"] for r in own})
        total += 10
    assert hits / total >= 0.9
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 0), key=lambda r: r["rank"])] == list(range(100, 110))
    assert {r["query_id"] for r in got} == set(range(0, 3000, 100))
    assert rp_forest.nearest_neighbours(table.limit(0)).count() == 0
    few = rp_forest.nearest_neighbours(table.where("vec_id < 4")).collect()
    assert [(r["query_id"], r["rank"]) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1), (0, 2), (0, 3)]


def _effort(spark, monkeypatch, x, every, **options):
    """The result, and the effort that was measured for it."""
    seen = []
    measure = rp_forest.needed_search
    monkeypatch.setattr(rp_forest, "needed_search", lambda *a: seen.append(measure(*a)) or seen[-1])
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = rp_forest.nearest_neighbours(table, every=every, search=1, **options).collect()
    monkeypatch.setattr(rp_forest, "needed_search", measure)
    return got, seen[0]


def _recall(got, x, every):
    hits = total = 0
    for query in range(0, len(x), every):
        distance = np.sqrt(((x - x[query]) ** 2).sum(1))
        distance[query] = np.inf
        hits += len(set(np.argsort(distance)[:10].tolist()) & {r["vec_id"] for r in got if r["query_id"] == query})
        total += 10
    return hits / total


def test_the_effort_follows_the_vectors_and_not_their_number(spark, monkeypatch):
    """Clusters need a few leaves at any size; vectors without structure need a share of the table."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(160, 24)) * 20
    found = {}
    for copies in (20, 80):
        x = np.repeat(centres, copies, axis=0)
        x = (x + rng.normal(size=x.shape) * 0.05)[rng.permutation(len(x))]
        got, found[copies] = _effort(spark, monkeypatch, x, len(x) // 40)
        assert _recall(got, x, len(x) // 40) >= 0.9
    assert found[80] < 0.05 * 16 * 80 * 160 and found[80] < 4 * found[20] + 16 * 64
    loose = rng.normal(size=(4000, 24))
    got, effort = _effort(spark, monkeypatch, loose, 50)
    assert effort > 1000 and _recall(got, loose, 50) >= 0.9


def test_the_effort_is_the_least_that_meets_a_vector():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 8))
    trees = [rp_forest.grow(x, 16, rng) for _ in range(4)]
    leaves = [t.leaf_of(x) for t in trees]
    sizes = [np.bincount(own, minlength=t.leaves) for own, t in zip(leaves, trees, strict=True)]
    for query in range(5):
        for wanted in range(100, 120):
            (need,) = rp_forest.efforts(trees, sizes, x[query], x[wanted : wanted + 1])

            def met(search, query=query, wanted=wanted):
                return any(leaves[k][wanted] == leaf for k, leaf in rp_forest.visit(trees, sizes, x[query], search))

            assert met(need) and not met(need - 1)


def test_the_best_of_many_cells():
    some = (np.array([1, 2, 1, 1]), np.array([5, 5, 7, 6]), np.array([0.5, 0.1, 0.2, 0.2]))
    more = (np.array([1, 2]), np.array([5, 5]), np.array([0.1, 0.1]))
    query, own, score = rp_forest._best([some, more], 2)
    assert list(zip(query.tolist(), own.tolist(), score.tolist(), strict=True)) == [(1, 5, 0.1), (1, 6, 0.2), (2, 5, 0.1)]
    assert not len(rp_forest._best([tuple(v[:0] for v in some)], 2)[0])


def test_a_vector_held_by_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "SALTS", 5)
    rows = [(i, [1.0, 1.0] if i % 3 == 0 else [float(i), 2.0], 0) for i in range(900)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7)
    got = rp_forest.nearest_neighbours(table).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 300) == [(k, 3 * (k - 1)) for k in range(1, 11)]
    assert sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0) == [(k, 3 * k) for k in range(1, 11)]


def test_large_leaves_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "CELL", 7)
    monkeypatch.setattr(rp_forest, "HELD", 30)  # tasks hand on what they hold many times
    rows = [(i, [float(i % 50), 1.0], 0) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = rp_forest.nearest_neighbours(table).collect()
    near = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 0)
    assert near == [(k, 50 * k, 0.0) for k in range(1, 8)] + [(k, v, 1.0) for k, v in ((8, 1), (9, 51), (10, 101))]


def test_rows_that_repeat_a_vec_id_take_one_place(spark):
    same = [(i, [1.0, 2.0], 0) for i in range(15) for _ in range(30)]
    near = [(20, [1.0, 2.5 + 0.1 * n], 0) for n in range(15)]
    got = rp_forest.nearest_neighbours(spark.createDataFrame(same + near, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(k, k, 0.0) for k in range(1, 11)]
    few = [r for r in same if r[0] < 4] + near
    got = rp_forest.nearest_neighbours(spark.createDataFrame(few, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0), (4, 20, 0.5)]


# --- secrets ----------------------------------------------------------------------


def test_secrets_of_odd_documents(spark):
    docs = odd_documents(spark).withColumn("spans", F.lit("clash"))
    extra = spark.createDataFrame([(20, 'é password = "x9$Kq2vL!mZ7" and token: information', "en", "s", 1, "")], docs.schema)
    got = {r["doc_id"]: r for r in secrets.find_secrets(docs.unionByName(extra)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for k, r in got.items() if k != 20)
    assert got[20]["spans"] == "guess:14:26,assign:32:50"
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_frequent_words_of_all_texts(spark):
    docs = spark.createDataFrame([(1, "Zebra zebra été ZEBRA of"), (2, None), (3, "été, ab zebras! zebras"), (4, "x" * 40)], "doc_id long, text string")
    assert secrets.frequent_words(docs) == ["zebra", "zebras", "été"]


# --- names ------------------------------------------------------------------------

HELPERS = ["_text", "_all", "_copies", "_copy", "_r1", "_r2", "_doc", "_row", "_spans", "_items", "dropped", "r1", "r2", "record", "copies", "copy", "all", "c0", "c1", "row", "a.b"]


def test_no_column_name_clashes(spark):
    from holdfast.llm import jaccard_join, line_dedup

    rows = [(1, "one two three four five six\nsecond line of it", "en", "s"), (2, None, "de", "t"), (3, "a b c d e f g h i j k", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({name: F.lit(name) for name in HELPERS})
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    items = spark.createDataFrame([("i", "a b c d e f g h i j")], "item_id string, text string")
    ways = {
        "leaks": lambda: decontaminate.find_leaks(docs, items),
        "secrets": lambda: secrets.find_secrets(docs),
        "quality": lambda: quality.score_quality(docs, labels),
        "copies": lambda: jaccard_join.keep_one(docs),
        "mix": lambda: mixing.mixed_documents(docs, mixing.Target(max_repeats=1)),
        "lines": lambda: line_dedup.drop_repeated_lines(docs),
    }
    want = sorted(map(repr, docs.collect()))
    for name, way in ways.items():
        got = way()
        assert got.columns[: len(docs.columns)] == docs.columns, name
        assert sorted(map(repr, got.select(*[f"`{c}`" for c in docs.columns]).collect())) == want, name
    assert ways["leaks"]().where("contaminated").select("doc_id").collect()[0][0] == 3


# --- pipeline ---------------------------------------------------------------------


def test_every_stage_takes_odd_and_empty_documents(spark, tmp_path):
    docs = odd_documents(spark)
    spark.createDataFrame([(3, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "another text of the same id")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = step(spark, given, str(tmp_path))
            assert out.columns == docs.columns, name
            rows = set(map(tuple, out.collect()))
            assert rows <= set(map(tuple, given.collect())), name
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 0 < len(found) and 7 in {r["doc_id"] for r in found}


def test_pipeline_on_the_driver_tables(spark):
    """Its stages, checked by hand on a small table."""
    from pathlib import Path

    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("driver tables not present")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.drop_low_quality(spark, docs, folder)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    wrong = [d for d, q in labels.items() if (d in kept) != bool(q)]
    assert len(wrong) <= 0.05 * len(labels)
    found = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in found.collect()} <= kept
