"""The pipeline against a version by hand, stage by stage, on driver documents with planted copies and leaks."""

import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline
from holdfast.llm.quality import score_quality
from holdfast.sources.tables import stage

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _one_of_each_group(docs):
    """doc_ids that stay: the smallest of each component of five-word shingle sets at 0.8, and all without words."""
    sets, holders, root = {}, defaultdict(list), {}
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        for shingle in sets[doc_id]:
            holders[shingle].append(doc_id)
        root[doc_id] = doc_id

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    common = Counter((a, b) for ids in holders.values() for i, a in enumerate(ids) for b in ids[i + 1 :])
    for (a, b), both in common.items():
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d for d in sets if not sets[d] or find(d) == d}


def _leaks(docs, items):
    """doc_ids with ten consecutive words of an item, or a whole shorter item."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))

    windows = defaultdict(set)
    for text in items:
        own = words(text)
        k = min(10, len(own))
        windows[k].update(tuple(own[i : i + k]) for i in range(len(own) - k + 1) if k)
    found = set()
    for doc_id, text in docs:
        own = words(text)
        if any(tuple(own[i : i + k]) in some for k, some in windows.items() for i in range(len(own) - k + 1) if k):
            found.add(doc_id)
    return found


def test_each_stage_by_hand(spark, tmp_path):
    plain = spark.read.parquet(f"{DATA}/documents.parquet")
    given = [r.asDict() for r in plain.orderBy("doc_id").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    long = [r for r in given if len((r["text"] or "").split()) > 80]
    top = max(r["doc_id"] for r in given)
    for i, row in enumerate(long[:30]):
        words = row["text"].split(" ")
        words[len(words) // 2] = "planted"
        given.append(row | {"doc_id": top + 1 + i, "text": row["text"] if i % 2 else " ".join(words)})
    for i, row in enumerate(long[30:45]):
        given.append(row | {"doc_id": top + 100 + i, "text": row["text"] + "\n" + items[i % len(items)]})
    spark.createDataFrame(given, plain.schema).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    folder = str(tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    def rows(df):
        return Counter(map(tuple, df.collect()))

    def pairs(df):
        return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]

    scored = score_quality(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)
    good = stage(corpus_pipeline.drop_low_quality(spark, docs, folder), "good")
    kept = {r["doc_id"] for r in scored if r["score"] >= 0.3}
    assert rows(good) == Counter({tuple(r.values()): 1 for r in given if r["doc_id"] in kept})

    single = stage(corpus_pipeline.drop_near_copies(spark, good, folder), "single")
    stay = _one_of_each_group(pairs(good))
    assert len(stay) < len(kept)
    assert rows(single) == Counter({r: 1 for r in rows(good) if dict(zip(good.columns, r, strict=True))["doc_id"] in stay})

    clean = stage(corpus_pipeline.drop_leaks(spark, single, folder), "clean")
    leaked = _leaks(pairs(single), items)
    assert leaked
    assert rows(clean) == Counter({r: 1 for r in rows(single) if dict(zip(single.columns, r, strict=True))["doc_id"] not in leaked})

    mixed = stage(corpus_pipeline.mix(spark, clean, folder), "mixed")
    assert set(rows(mixed)) == set(rows(clean)) and max(rows(mixed).values()) <= 2

    library, start, want = Tokenizer.from_file(path("byte_bpe_50k.json")), 0, []
    for doc_id, text in pairs(mixed):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = corpus_pipeline.run(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == want
