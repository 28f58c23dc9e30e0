"""Spelling variants against a brute-force version over whole small tables."""

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from holdfast.llm import queries, spelling

DATA = Path("/root/testdata/sf0.001")


def words_by_hand(rows, least=6, times=5, typo=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % typo == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= times}


def edits(word, alphabet):
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    made = {a + b[1:] for a, b in cuts if b}
    made |= {a + c + b for a, b in cuts for c in alphabet}
    made |= {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return made - {word}


def variants_by_hand(counts):
    alphabet = sorted(set("".join(counts)))
    near = {w: [v for v in edits(w, alphabet) if v in counts] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")
def test_query_equals_brute_force_on_whole_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    counts = words_by_hand([tuple(r) for r in docs])
    assert len(counts) > 300
    assert result(queries.op12_spelling_variants(spark, str(DATA))) == variants_by_hand(counts)


def test_vocabulary_of_odd_texts(spark):
    rows = [
        (None, "Straße STRASSE straße Ünïcode" * 9), (1, None), (2, ""), (3, "short word runs"),
        (4, "abcdefg-abcdefg_abcdefg9abcdefg " * 40), (5, "x" * 70000 + " yyyyyyy" * 5), (6, "ÀÀÀÀÀÀ ÷÷÷÷÷÷ " * 6),
    ]
    rows += [(k, "mistyped wordwords repeated") for k in range(3000)] + [(7, "mistyped wordwords")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    got = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    assert got == words_by_hand(rows)
    assert any(w in got for w in ("istyped", "mstyped", "mityped", "mistped", "mistyed", "mistypd", "mistype"))


def test_variants_of_dense_words_with_ties_and_chains(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))): 5 ** rng.randrange(1, 6) for _ in range(900)}
    counts |= {"aaaaaa": 7, "aaaaaaa": 40, "aaaaaaaa": 1000, "baaaaaaa": 10**6, "lonelyword": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = variants_by_hand(counts)
    assert result(spelling.group_variants(words)) == want
    assert any(form not in (None, root) for _, form, root, *_ in want)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "too few words here")], "doc_id long, text string")
    assert spelling.spelling_variants(docs).count() == 0
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
