"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A ledger is a folder of tables. Each batch has a folder in `state` (what each changed document counts
since then, in BUCKETS folders by the hash of its key), in `deltas` (the batch's signed change of each
total, already added up) and in `commits` (one row, written last). A total is the sum of the deltas of
committed batches. A batch that failed on its way has no commit: it is not seen, and writing it again
replaces its folders. A batch that is committed is not applied again, so any number of retries count once.

A compaction adds up what is committed: one state row per living key, one row per total, the numbers of the
batches. Later batches read its state and that of the batches since, of the buckets they touch only, so
the cost of a batch does not grow with the number of batches before it. One writer at a time may work on a ledger.

Tokens are counted by the tokenizers library, or as words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.encoder import encoder
from holdfast.llm.text import ALNUM, SPACED, Alphabet, pieces, word_spans
from holdfast.sources.tables import _delete, stage

#: Folders of each batch's state; the same for the life of a ledger.
BUCKETS = 64
#: Batches after which a commit compacts.
COMPACT_EVERY = 32
#: A text of more rows than this, and than a thousandth of all, is hot: at most 1,000 are.
HOT_ROWS = 1000

_KEY = ["doc_id", "record", "tokenizer"]
_STATE = "doc_id long, record long, tokenizer string, source string, lang string, docs long, tokens long, alive boolean"
_DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"
_COMMITS = "changes long"
#: Columns of a change; `record` (null if absent) and `docs` (1 if absent) may follow.
CHANGE = "op string, seq long, doc_id long, tokenizer string, source string, lang string, tokens long"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer version: a byte-level BPE file of the tokenizers library, or words of an alphabet."""

    version: str
    path: str | None = None
    alphabet: Alphabet = SPACED

    def counts(self, batch: pa.RecordBatch) -> np.ndarray:
        """Tokens of each text of a batch; a null text has none."""
        if self.path is not None:
            found = [len(ids) for _, some in encoder(self.path).batch(batch, "text") for ids in some]
            return np.array(found, np.int64)
        parts = [np.diff(word_spans(data, bounds, self.alphabet)[2]) for _, data, bounds in pieces(batch, "text")]
        return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)


#: Runs of anything but white space; runs of ASCII letters, digits and anything outside ASCII.
WORDS_1, WORDS_2 = Tokenizer("words@1"), Tokenizer("words@2", alphabet=ALNUM)


def _counter(tokenizers: tuple[Tokenizer, ...]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if c != "text"]
            counts = [pa.array(t.counts(batch), pa.int64()) for t in tokenizers]
            columns = [batch.column(c) for c in names] + counts
            yield pa.RecordBatch.from_arrays(columns, names + [f"n{i}" for i in range(len(counts))])

    return run


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, text and `record`: a hash of the row, which tells rows of one doc_id apart."""
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")))
    parts = [part for c in ("text", "source", "lang") for part in (F.col(c), F.col(c).isNull())]
    return typed.withColumn("record", F.xxhash64(*parts))


def _spread(rows: DataFrame, tokenizers: tuple[Tokenizer, ...], op: str, seq: int, counted: bool) -> DataFrame:
    versions = F.array(
        *(
            F.struct(F.lit(t.version).alias("tokenizer"), (F.col(f"n{i}") if counted else F.lit(0).cast("long")).alias("tokens"))
            for i, t in enumerate(tokenizers)
        )
    )
    return rows.select(
        F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), "doc_id", "source", "lang", "record", "docs",
        F.explode(versions).alias("v"),
    ).select("op", "seq", "doc_id", "v.tokenizer", "source", "lang", "v.tokens", "record", "docs")


def inserts(rows: DataFrame, *tokenizers: Tokenizer, op: str = "insert", seq: int = 0) -> DataFrame:
    """A change per row of `identified` and tokenizer version; equal rows become one change with their number."""
    schema = "doc_id long, source string, lang string, record long, " + ", ".join(f"n{i} long" for i in range(len(tokenizers)))
    counted = rows.select("doc_id", "source", "lang", "record", "text").mapInArrow(_counter(tokenizers), schema)
    sums = counted.groupBy("doc_id", "record", "source", "lang").agg(
        F.count("*").alias("docs"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(len(tokenizers)))
    )
    return _spread(sums, tokenizers, op, seq, counted=True)


def deletes(rows: DataFrame, *tokenizers: Tokenizer, seq: int = 0) -> DataFrame:
    """A change per row and tokenizer version that takes it out; needs doc_id, record, source and lang."""
    return _spread(rows.withColumn("docs", F.lit(0).cast("long")), tokenizers, "delete", seq, counted=False)


class Ledger:
    """Totals kept in a folder of a store that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        for folder in ("commits/batch=0", "compactions/through=0"):
            spark.createDataFrame([], _COMMITS).write.mode("ignore").parquet(f"{path}/{folder}")

    def _table(self, schema: str, *paths: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def through(self) -> int:
        """The last batch of the newest compaction, 0 without one."""
        seen = self._table(f"{_COMMITS}, through long", f"{self.path}/compactions")
        return seen.agg(F.max("through")).first()[0] or 0

    def committed(self) -> list[int]:
        """Numbers of the batches that are committed since the newest compaction, COMPACT_EVERY at most."""
        seen = self._table(f"{_COMMITS}, batch long", f"{self.path}/commits").where(F.col("batch") > self.through())
        return sorted(r[0] for r in seen.select("batch").collect())

    def _compacted(self, batch: int, through: int) -> bool:
        return through > 0 and not self._table("batch long", f"{self.path}/base/{through}/commits").where(F.col("batch") == batch).isEmpty()

    def _state(self, through: int, batches: list[int], buckets: list[int] | None = None) -> DataFrame:
        """State rows (several of a key, the newest of the greatest batch), of these buckets only."""
        folders = [(through, f"{self.path}/base/{through}/state")] if through else []
        folders += [(b, f"{self.path}/state/batch={b}") for b in batches]
        found = self._table(f"{_STATE}, bucket int, batch long").limit(0)
        for batch, folder in folders:
            rows = self._table(f"{_STATE}, bucket int", folder)
            rows = rows if buckets is None else rows.where(F.col("bucket").isin(buckets))
            found = found.unionByName(rows.withColumn("batch", F.lit(batch).cast("long")))
        return found

    def _write_state(self, rows: DataFrame, path: str) -> None:
        bucket = F.pmod(F.xxhash64(*_KEY), F.lit(BUCKETS)).cast("int")
        # A rebalance brings a bucket together, and splits it where it is large.
        dealt = rows.withColumn("bucket", bucket).hint("rebalance", F.col("bucket"))
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch of changes (CHANGE); False if it is committed already.

        Batches are numbered from 1 and must be applied in ascending order. `insert` and `revise` set
        what a document counts (its source and language may move); `delete` takes it out; deleting
        what isn't there changes nothing. A document is known by doc_id and `record`, and may stand for
        several rows (`docs`). Of several changes of a document and tokenizer version in one
        batch that with the greatest seq holds, ties going to the greatest row. Rows with neither
        doc_id nor record, or with another op, are left out.
        """
        done, through = self.committed(), self.through()
        if batch in done or self._compacted(batch, through):
            return False
        newest = done[-1] if done else through
        if batch < 1 or batch < newest:
            raise ValueError(f"batch {batch} comes before batch {newest}")
        for name, default in (("record", None), ("docs", 1)):
            if name not in changes.columns:
                changes = changes.withColumn(name, F.lit(default).cast("long"))
        known = F.col("doc_id").isNotNull() | F.col("record").isNotNull()
        wanted = changes.where(known & F.col("op").isin("insert", "revise", "delete"))
        last = wanted.groupBy(*_KEY).agg(F.max(F.struct("seq", "op", "source", "lang", "tokens", "docs")).alias("c"))
        alive = F.col("c.op") != "delete"
        now = last.select(
            *_KEY,
            F.when(alive, F.col("c.source")).alias("source"),
            F.when(alive, F.col("c.lang")).alias("lang"),
            F.when(alive, F.col("c.docs")).otherwise(F.lit(0)).alias("docs"),
            F.when(alive, F.col("c.tokens")).otherwise(F.lit(0)).alias("tokens"),
            alive.alias("alive"),
        )
        self._write_state(now, f"{self.path}/state/batch={batch}")
        now = self._table(f"{_STATE}, bucket int", f"{self.path}/state/batch={batch}")
        touched = [r[0] for r in now.select("bucket").distinct().collect()]  # BUCKETS at most
        n, b = now.select(*_KEY).alias("n"), self._state(through, done, touched).alias("b")
        same = F.col("n.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("n.record").eqNullSafe(F.col("b.record"))
        before = b.join(n, same & F.col("n.tokenizer").eqNullSafe(F.col("b.tokenizer")), "left_semi")
        old = before.groupBy(*_KEY).agg(F.max_by(F.struct("source", "lang", "docs", "tokens", "alive"), "batch").alias("s")).select(*_KEY, "s.*")
        total = ["source", "lang", "tokenizer"]
        signed = now.where("alive").select(*total, "docs", "tokens").unionByName(
            old.where("alive").select(*total, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        )
        deltas = signed.groupBy(*total).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        now.agg(F.count("*").alias("changes")).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        if len(done) + 1 >= COMPACT_EVERY:
            self.compact()
        return True

    def _sums(self, through: int, batches: list[int]) -> DataFrame:
        folders = [f"{self.path}/base/{through}/totals"] if through else []
        seen = self._table(_DELTAS, *folders, *(f"{self.path}/deltas/batch={b}" for b in batches))
        sums = seen.groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens of what is there; groups without documents are gone."""
        return self._sums(self.through(), self.committed())

    def compact(self) -> int:
        """Add up all committed batches; the number of the last. It counts once its marker, written last, is there."""
        through, done = self.through(), self.committed()
        if not done:
            return through
        folder = f"{self.path}/base/{done[-1]}"
        newest = self._state(through, done).groupBy(*_KEY).agg(
            F.max_by(F.struct("source", "lang", "docs", "tokens", "alive"), "batch").alias("s")
        )
        self._write_state(newest.select(*_KEY, "s.*").where("alive"), f"{folder}/state")
        self._sums(through, done).write.mode("overwrite").parquet(f"{folder}/totals")
        numbers = self.spark.createDataFrame([(b,) for b in done], "batch long")
        if through:
            numbers = numbers.unionByName(self._table("batch long", f"{self.path}/base/{through}/commits"))
        numbers.coalesce(1).write.mode("overwrite").parquet(f"{folder}/commits")
        marker = self.spark.createDataFrame([(len(done),)], _COMMITS)
        marker.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/compactions/through={done[-1]}")
        return done[-1]

    def vacuum(self) -> None:
        """Delete what the newest compaction replaces; no one may be reading it."""
        through = self.through()
        commits = self._table(f"{_COMMITS}, batch long", f"{self.path}/commits").where(F.col("batch").between(1, through))
        for (batch,) in commits.select("batch").collect():
            for table in ("state", "deltas", "commits"):
                _delete(self.spark, f"{self.path}/{table}/batch={batch}")
        older = self._table(f"{_COMMITS}, through long", f"{self.path}/compactions").where(F.col("through").between(1, through - 1))
        for (number,) in older.select("through").collect():
            _delete(self.spark, f"{self.path}/compactions/through={number}")
            _delete(self.spark, f"{self.path}/base/{number}")


def exact_copies(rows: DataFrame) -> DataFrame:
    """doc_id, record, source and lang of rows of `identified` whose whole text a smaller doc_id has too.

    A null doc_id is larger than any other, a null text is an empty one; rows of the same doc_id are no copies of each other.
    Texts are compared by two 64-bit hashes, so only hashes are shuffled; those of hot texts are not.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = stage(
        rows.select("doc_id", "record", "source", "lang", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")), "text_hashes"
    )
    groups = stage(hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "text_groups")
    hot = F.col("n") > max(HOT_ROWS, (groups.agg(F.sum("n")).first()[0] or 0) // 1000)
    few = F.broadcast(groups.where(hot).drop("n"))
    found = hashed.join(few, ["h1", "h2"]).unionByName(
        hashed.join(few, ["h1", "h2"], "left_anti").join(groups.where(~hot & (F.col("n") > 1)).drop("n"), ["h1", "h2"])
    )
    return found.where(~F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "record", "source", "lang")


def without_license_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"(?m)^Licensed under .*$", "")


def corpus_totals(docs: DataFrame, path: str, *tokenizers: Tokenizer) -> DataFrame:
    """Totals of a corpus after its life so far: all documents inserted, their counts revised without
    license lines, exact copies deleted; the last two batches arrive twice, the second time after a compaction.

    Takes doc_id, source, lang and text. Every row counts, also those without or with the same doc_id; null sources and
    languages are groups of their own; an empty table has no totals. Without tokenizers it counts words.
    """
    tokenizers = tokenizers or (WORDS_1, WORDS_2)
    ledger, rows = Ledger(docs.sparkSession, path), identified(docs)
    ledger.commit(1, inserts(rows, *tokenizers))
    licensed = rows.where(F.col("text").rlike(r"(?m)^Licensed under "))
    revised = inserts(licensed.withColumn("text", without_license_lines(F.col("text"))), *tokenizers, op="revise", seq=1)
    copies = deletes(exact_copies(rows), *tokenizers, seq=2)
    for batch, changes in ((2, revised), (3, copies)):
        ledger.commit(batch, changes)
    ledger.compact()
    for batch, changes in ((2, revised), (3, copies)):
        ledger.commit(batch, changes)
    return ledger.totals()
