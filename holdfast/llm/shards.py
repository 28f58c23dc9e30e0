"""Shards of nearly equal bytes over fixed virtual slots.

A record's key is hashed into one of SLOTS virtual slots, which never change. A table says which shard
holds each slot; it is fitted to the bytes of the slots, stored by version, and edited when shards are
added or have drifted apart: only slots that overfull shards give up, or that have no shard, move. Slots
are cut into CELLS cells, the groups in which records are sorted and numbered, so that no task ever holds
a slot or a shard. Everything runs on DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.sources.tables import scratch_path

SLOTS = 4096
CELLS = 16
#: A cell of more rows than this, and of more than one in SLOTS / 4 of all rows, holds a repeated key.
HOT_ROWS = 1000
MAP = "slot int, shard int, bytes long"


def _cell(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS * CELLS)).cast("int")


def _slot() -> Column:
    return F.floor(F.col("cell") / CELLS).cast("int")


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) and its end mark."""
    return F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 1


def cell_sizes(docs: DataFrame, key: list[str], size: Column) -> DataFrame:
    """(cell, rows, bytes); at most SLOTS * CELLS rows, summed map-side first."""
    return (
        docs.select(_cell(key).alias("cell"), size.alias("size"))
        .groupBy("cell")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    )


def hot_cells(cells: DataFrame) -> DataFrame:
    """Cells of one key that stands in very many rows; fewer than SLOTS / 4."""
    share = cells.agg(F.sum("rows") * 4 / SLOTS).scalar()
    return cells.where(F.col("rows") > F.greatest(F.lit(HOT_ROWS), share)).select("cell", "bytes")


def slot_sizes(cells: DataFrame) -> DataFrame:
    """(slot, bytes) of every slot, empty ones included. Rows of hot cells are dealt over all slots."""
    spread = hot_cells(cells).agg(F.coalesce(F.floor(F.sum("bytes") / SLOTS), F.lit(0)).cast("long")).scalar()
    settled = cells.join(F.broadcast(hot_cells(cells).select("cell")), "cell", "left_anti")
    own = settled.groupBy(_slot().alias("slot")).agg(F.sum("bytes").alias("own"))
    every = cells.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    return every.join(F.broadcast(own), "slot", "left").select(
        "slot", (F.coalesce("own", F.lit(0)) + spread).alias("bytes")
    )


def edit_map(sizes: DataFrame, shards: int, current: DataFrame | None = None, slack: float = 0.0) -> DataFrame:
    """The slot-to-shard map for `shards` shards: (slot, shard, bytes).

    A shard that holds more than a fair share of the bytes and `slack` of it keeps its largest slots up to the
    fair share, others keep all; what lies beyond, slots of shards that are no more and slots without a shard go, the largest first, each to the shard with
    the fewest bytes (smallest number, if several). Without a current map every slot is dealt that way.
    """
    known = sizes.select("slot", "bytes")
    if current is None:
        placed = known.withColumn("shard", F.lit(None).cast("int"))
    else:
        held = current.where(F.col("shard") < shards).select("slot", "shard")
        placed = known.join(F.broadcast(held), "slot", "left")
    fair = known.agg(F.sum("bytes") / shards).scalar()
    upto = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    judged = placed.withColumn("upto", F.sum("bytes").over(upto))
    judged = judged.withColumn("held", F.sum("bytes").over(Window.partitionBy("shard")))
    fits = (F.col("upto") <= fair) | (F.col("held") <= fair * (1 + slack))
    judged = judged.withColumn("stays", F.col("shard").isNotNull() & fits)

    # One row of a fixed size: what each shard keeps, and the slots to deal.
    one = judged.agg(
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
        F.array_sort(
            F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), F.col("slot"))))
        ).alias("pool"),
    )

    def load(shard: Column) -> Column:
        own = F.filter("kept", lambda x: x["shard"] == shard)
        return F.aggregate(own, F.lit(0).cast("long"), lambda sum, x: sum + x["bytes"])

    def deal(state: Column, item: Column) -> Column:
        def give(place: Column) -> Column:
            loads = F.transform(state["loads"], lambda x, i: x - F.when(i == place - 1, item["less"]).otherwise(0))
            return F.struct(
                loads.alias("loads"), F.concat(state["owners"], F.array((place - 1).cast("int"))).alias("owners")
            )

        lightest = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        return F.transform(F.array(lightest), give)[0]

    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), load)
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("owners"))
    dealt = one.select(
        F.explode(F.arrays_zip("pool", F.aggregate("pool", start, deal)["owners"].alias("owners"))).alias("x")
    )
    return judged.where("stays").select("slot", "shard", "bytes").unionByName(
        dealt.select("x.pool.slot", F.col("x.owners").alias("shard"), (-F.col("x.pool.less")).alias("bytes"))
    )


def store_map(shard_map: DataFrame, path: str, version: int) -> DataFrame:
    """Write a map as a new version; an existing version is never changed."""
    folder = f"{path}/version={version}"
    shard_map.coalesce(1).write.mode("errorifexists").parquet(folder)
    return shard_map.sparkSession.read.schema(MAP).parquet(folder)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, DataFrame]:
    """A version of the map, the newest by default, and its number."""
    versions = spark.read.schema(f"{MAP}, version int").parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return version, versions.where(F.col("version") == version).drop("version")


def rebalance(sizes: DataFrame, shards: int, path: str, slack: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Edit the newest map for the present sizes, store it as the next version, and return it with
    the moves: (slot, source, target, bytes). Only those slots' records have to be written again."""
    spark = sizes.sparkSession
    version, current = read_map(spark, path)
    edited = store_map(edit_map(sizes, shards, current, slack), path, version + 1)
    old = current.select("slot", F.col("shard").alias("source"))
    moves = edited.join(F.broadcast(old), "slot").where("shard <> source")
    return edited, moves.select("slot", "source", F.col("shard").alias("target"), "bytes")


def write_shards(docs: DataFrame, key: list[str], cells: DataFrame, shard_map: DataFrame, path: str) -> DataFrame:
    """Write whole records, one folder a shard, and read them back: (record, cell, shard).

    A record is a struct of all columns, so no name can clash. Tasks take ranges of cells, so a shard has
    as many files as its bytes ask for. Rows of hot cells are told apart by where they stand in
    the input, so give a table that is read from files.
    """
    hot = F.broadcast(hot_cells(cells).select("cell", F.lit(True).alias("hot")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), _cell(key).alias("cell"))
    anywhere = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SLOTS * CELLS)).cast("int")
    rows = rows.join(hot, "cell", "left").select(
        "record", F.when(F.col("hot"), anywhere).otherwise(F.col("cell")).alias("cell")
    )
    owners = F.broadcast(shard_map.select("slot", "shard"))
    dealt = rows.withColumn("slot", _slot()).join(owners, "slot").select("record", "cell", "shard")
    dealt.repartitionByRange("shard", "cell").sortWithinPartitions("shard", "cell").write.partitionBy("shard").parquet(
        path
    )
    fields = [T.StructField("record", docs.schema), T.StructField("cell", T.IntegerType())]
    schema = T.StructType([*fields, T.StructField("shard", T.IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)


def with_places(stored: DataFrame, order: list[Column]) -> DataFrame:
    """`place` of each record in its shard, without gaps from 0: by cell, then by `order`.

    Counts by cell give where each cell begins; a cell is small, so its records are simply numbered.
    """
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        stored.groupBy("shard", "cell")
        .agg(F.count("*").alias("held"))
        .select("shard", "cell", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin"))
    )
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy(*order))
    return (
        stored.withColumn("inside", inside)
        .join(begins, ["shard", "cell"])
        .withColumn("place", F.col("begin") + F.col("inside") - 1)
        .drop("begin", "inside")
    )


def shard_documents(docs: DataFrame, shards: int = 16, path: str | None = None) -> DataFrame:
    """Write documents into shards of nearly equal bytes and number them: (record, cell, shard, place).

    `path` gets the records (`records/shard=N`) and version 1 of the map (`map`). Columns are kept as
    fields of `record`, whatever their names. A null text has no bytes but its end mark; a null doc_id is a key
    like others; rows of one doc_id share a slot unless they are so many that they are dealt over all
    slots; equal rows are numbered in any order. An empty table gives no rows (its map holds all slots).
    """
    folder = path or scratch_path(docs.sparkSession, "shards")
    key = ["doc_id"]
    cells = folder + "/cells"
    cell_sizes(docs, key, text_bytes()).write.parquet(cells)
    sizes = docs.sparkSession.read.schema("cell int, rows long, bytes long").parquet(cells)
    shard_map = store_map(edit_map(slot_sizes(sizes), shards), f"{folder}/map", 1)
    stored = write_shards(docs, key, sizes, shard_map, f"{folder}/records")
    narrow = stored.select(
        "cell", "shard",
        F.col("record.doc_id").alias("doc_id"),
        text_bytes("record.text").alias("size"),
        F.crc32(F.coalesce(F.col("record.text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return with_places(narrow, [F.col("doc_id"), F.col("size"), F.col("text_crc32")])
