"""Virtual-slot shards: places, balance, whole records, versions of the map and what an edit moves."""

import zlib

import pytest
from pyspark.sql import functions as F

from holdfast.llm import shards
from holdfast.sources.tables import scratch_path

DOCS = "doc_id long, text string, shard string, cell int, record int, place int"


def documents(spark, n=600):
    rows = [(k, "é" * (k * 37 % 400) if k % 11 else None, "x", 1, 2, 3) for k in range(n)]
    rows += [(None, "no id", None, None, None, None)] * 3 + [(5, "again", "x", 1, 2, 3)] * 4
    rows += [(10**9, "w" * 40000, "", 0, 0, 0), (7, "", "y", 0, 0, 0)]
    return spark.createDataFrame(rows, DOCS)


def sizes(spark, values):
    rows = [(k, values[k % len(values)] * (1 + k % 7)) for k in range(shards.SLOTS)]
    return spark.createDataFrame(rows, "slot int, bytes long")


def loads(shard_map, n):
    found = [0] * n
    for r in shard_map.collect():
        found[r["shard"]] += r["bytes"]
    return found


def deal_by_hand(rows, n):
    held, owner = [0] * n, {}
    for slot, size in sorted(rows, key=lambda r: (-r[1], r[0])):
        shard = held.index(min(held))
        owner[slot] = shard
        held[shard] += size
    return owner


def test_shards_hold_every_record_once(spark):
    docs, folder = documents(spark), scratch_path(spark, "shards")
    got = shards.shard_documents(docs, 4, folder).collect()
    want = sorted(
        ((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()),
        key=repr,
    )
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    for shard in range(4):
        assert sorted(r["place"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    held = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(held) - min(held) < 400
    files = spark.read.parquet(f"{folder}/records").select("record.*")
    assert files.columns == docs.columns
    assert sorted(map(repr, files.collect())) == sorted(map(repr, docs.collect()))


def test_map_equals_dealing_by_hand(spark):
    table = sizes(spark, [5, 0, 17, 3, 90])
    got = {r["slot"]: r["shard"] for r in shards.edit_map(table, 7).collect()}
    assert got == deal_by_hand([tuple(r) for r in table.collect()], 7)


def test_edit_moves_only_what_is_too_much(spark):
    folder, table = scratch_path(spark, "map"), sizes(spark, [100, 90, 80])
    first = shards.store_map(shards.edit_map(table, 16), folder, 1)
    grown, moves = shards.rebalance(table, 17, folder)
    moved, total = moves.collect(), sum(loads(first, 16))
    added = sum(r["bytes"] for r in moved if r["target"] == 16)
    assert 0.95 * total / 17 < added and sum(r["bytes"] for r in moved) < 1.15 * total / 17
    held = loads(grown, 17)
    assert max(held) - min(held) < 0.03 * total / 17
    assert shards.read_map(spark, folder)[0] == 2 and shards.read_map(spark, folder, 1)[1].count() == shards.SLOTS
    again, none = shards.rebalance(table, 17, folder)
    assert none.count() == 0 and loads(again, 17) == held
    shrunk, moves = shards.rebalance(table, 15, folder)
    assert {r["source"] for r in moves.collect()} >= {15, 16} and max(r["shard"] for r in shrunk.collect()) == 14
    with pytest.raises(Exception, match="exists"):
        shards.store_map(first, folder, 2)


def test_one_key_in_most_rows_is_dealt_over_all_shards(spark):
    same = spark.range(6000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    rest = spark.range(3000).select((F.col("id") + 2).alias("doc_id"), F.lit("other").alias("text"))
    got = shards.shard_documents(same.unionByName(rest), 8).collect()
    held = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert len(got) == 9000 and max(held) < 1.1 * min(held)
    for shard in range(8):
        assert sorted(r["place"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))


def test_empty_table(spark):
    folder = scratch_path(spark, "none")
    assert shards.shard_documents(spark.createDataFrame([], DOCS), 3, folder).count() == 0
    assert shards.read_map(spark, f"{folder}/map")[1].count() == shards.SLOTS
