"""Training-data queries that SQL can express, against their SQL; and the columns the others promise."""

from pathlib import Path

import pytest

from holdfast.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        duck.sql(f"create view {file.stem} as select * from '{file}'")
    want = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, str(DATA)).select(*[f"`{c}`" for c in want.columns])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_ledger_matches_sql_on_words_and_the_library_on_bpe(spark):
    """Word versions against SQL; BPE counts against the library's own, over the same documents."""
    import re
    from collections import Counter

    import duckdb
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from holdfast.llm import oracle

    found = [tuple(r) for r in queries.queries()["op8_token_count_ledger"](spark, str(DATA)).select("source", "lang", "tokenizer", "docs", "tokens").collect()]
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{DATA}/documents.parquet'")
    words = duck.sql(oracle.OP8_WORDS).fetchall()
    assert sorted(map(repr, [r for r in found if r[2] != "byte_bpe_50k@1"])) == sorted(map(repr, words))
    library, first, docs, tokens = Tokenizer.from_file(path("byte_bpe_50k.json")), set(), Counter(), Counter()
    for source, lang, text in duck.sql("select source, lang, coalesce(text, '') from documents order by doc_id").fetchall():
        if text not in first:
            first.add(text)
            kept = re.sub(r"(?m)^Licensed under .*$", "", text)
            docs[source, lang] += 1
            tokens[source, lang] += len(library.encode(kept, add_special_tokens=False).ids)
    assert {r[:2]: r[3:] for r in found if r[2] == "byte_bpe_50k@1"} == {k: (docs[k], tokens[k]) for k in docs}


def test_new_queries_have_the_columns_of_their_contracts(spark):
    built = queries.queries()
    assert [int(name[2:].split("_")[0]) for name in built] == list(range(1, 14))
    shards = dict(built["op13_virtual_slot_shards"](spark, str(DATA)).dtypes)
    assert shards == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    }
    words = dict(built["op12_spelling_variants"](spark, str(DATA)).dtypes)
    assert words == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
