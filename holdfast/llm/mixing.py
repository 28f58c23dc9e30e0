"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power `a`, normalised: 1 keeps the shares, 0 makes all
sources equal. `a` is bisected to the flattest mix that meets the target entropy and the repetition
limit. The weights are then realised in tokens: each source is a stream of seeded permutations of its
documents, one an epoch, cut at its quota, and the streams are dealt out to blocks in step, so that
every block has the mix.

Documents travel as rows without their text. Running sums are two-level (by hash bucket, then within
one), so a source of any size spreads over many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.sources.tables import stage

#: Bisection steps of one pass over the sources, and passes.
_STEPS, _PASSES = 6, 6
#: Documents of a source and epoch that meet in one bucket, about.
_BUCKET_ROWS = 5000

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """evenness: entropy of the mix over the log of the number of sources, at most; max_repeats:
    epochs of any source, at most; budget: tokens of the mix. Without a budget the mix is as small as
    it can be with every document in it at least once."""

    evenness: float = 0.92
    max_repeats: float = 2.0
    budget: int | None = None
    block_tokens: int = 1 << 20
    seed: int = 17


def tokens_of(text: Column) -> Column:
    """Words of a text and one for its end; a null is empty."""
    inner = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return (F.when(inner == "", 0).otherwise(F.size(F.split(inner, SPACE))) + 1).cast("long")


def _units(docs: DataFrame) -> DataFrame:
    """(r1, r2, doc_id, source, tokens, rows): rows equal in doc_id, source and text are one unit."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        *_keys(), F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), tokens_of(text).alias("tokens")
    )
    return rows.groupBy("r1", "r2", "doc_id", "source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))


def _keys() -> list[Column]:
    parts = [F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))]
    return [F.xxhash64(*parts).alias("r1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("r2")]


def find_exponent(sizes: DataFrame, target: Target) -> float:
    """The smallest exponent in [0, 1] whose mix of sources (source, n) meets the target; 1 if none does."""
    n_sources, total = sizes.agg(F.count("*"), F.sum("n")).first()
    if not n_sources:
        return 1.0
    shares = sizes.select((F.col("n") / F.lit(float(total))).alias("p"))
    most = target.evenness * math.log(n_sources) + 1e-12
    low, high = 0.0, 1.0
    for _ in range(_PASSES):
        points = [low + (high - low) * k / (1 << _STEPS) for k in range(1 << _STEPS)]
        grid = shares.withColumn("a", F.explode(F.array(*map(F.lit, points))))
        weight, ratio = F.pow("p", F.col("a")), F.pow("p", F.col("a") - 1)
        sums = grid.groupBy("a").agg(
            F.sum(weight).alias("z"), F.sum(weight * F.log("p")).alias("l"), F.max(ratio).alias("top"), F.min(ratio).alias("low")
        )
        met = []
        for a, z, l, top, least in sums.collect():  # one row a point
            repeats = top / least if target.budget is None else top / z * target.budget / total
            if math.log(z) - a * l / z <= most and repeats <= target.max_repeats * (1 + 1e-9):
                met.append(a)
        first = min(met, default=high)
        at = points.index(first) if first in points else len(points)
        if at == 0:
            return first
        low, high = points[at - 1], first
    return high


def quotas(sizes: DataFrame, target: Target) -> tuple[DataFrame, int]:
    """(source, n, weight, quota in tokens) of each source, and the tokens of the mix.

    A budget beyond max_repeats epochs of everything is cut to that.
    """
    exponent = find_exponent(sizes, target)
    z, total = sizes.agg(F.sum(F.pow(F.col("n").cast("double"), F.lit(exponent))), F.sum("n")).first()
    weighted = sizes.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(exponent)) / F.lit(z or 1.0))
    if target.budget is None:
        budget = weighted.agg(F.max(F.col("n") / F.col("weight"))).first()[0] or 0.0
        quota = F.greatest("n", F.round(F.col("weight") * budget).cast("long"))
    else:
        budget = float(min(target.budget, target.max_repeats * (total or 0)))
        quota = F.round(F.col("weight") * budget).cast("long")
    planned = stage(weighted.withColumn("quota", quota), "quotas")
    return planned, planned.agg(F.sum("quota")).first()[0] or 0


def draw(units: DataFrame, target: Target) -> DataFrame:
    """Every unit in every epoch it is drawn in: the unit's columns, epoch, block and position.

    position is the number of the source's tokens drawn before; a unit is drawn when its source's
    quota isn't full before it. Ties in the permutation fall to the unit's hashes.
    """
    sizes = stage(units.groupBy("source").agg(F.sum("tokens").alias("n"), F.count("*").alias("units")), "sizes")
    planned, total = quotas(sizes.select("source", "n"), target)
    largest = sizes.agg(F.max("units")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(max(2, largest / _BUCKET_ROWS))))
    blocks = max(1, -(-total // target.block_tokens))

    epochs = F.sequence(F.lit(0), F.ceil(F.col("quota") / F.col("n")).cast("int") - 1)
    dealt = units.join(planned.where("quota > 0"), "source").withColumn("epoch", F.explode(epochs))
    dealt = dealt.withColumn("order", F.xxhash64(F.lit(target.seed), "epoch", "r1", "r2"))
    dealt = dealt.withColumn("bucket", F.shiftrightunsigned("order", 64 - bits))
    key = ["source", "epoch", "bucket"]
    sums = dealt.groupBy(*key).agg(F.sum("tokens").alias("own"))
    earlier = Window.partitionBy("source").orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*key, F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"))
    before = Window.partitionBy(*key).orderBy("order", "r1", "r2").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("within", F.coalesce(F.sum("tokens").over(before), F.lit(0))).join(bases, key)
    placed = placed.withColumn("position", F.col("base") + F.col("within")).where("position < quota")
    share = F.col("position") / F.col("quota")
    return placed.select(
        *units.columns, "epoch", F.least(F.floor(share * blocks), F.lit(blocks - 1)).cast("long").alias("block"), "position"
    )


def mix_sources(docs: DataFrame, target: Target) -> DataFrame:
    """doc_id, source, tokens, rows, epoch, block, position for every document drawn.

    Takes doc_id, source and text. A null source counts as ''; rows equal in all three are drawn
    together, with their tokens added up in `tokens` and their number in `rows`. Within a block the
    order is that of `place`, a seeded permutation over all sources. Other columns are ignored.
    """
    drawn = draw(stage(_units(docs), "units"), target)
    place = F.xxhash64(F.lit(target.seed), "block", "epoch", "r1", "r2").alias("place")
    return drawn.select("doc_id", "source", "tokens", "rows", "epoch", "block", "position", place)


def mixed_documents(docs: DataFrame, target: Target) -> DataFrame:
    """The documents, all their columns, each as often as it is drawn."""
    copies = draw(stage(_units(docs), "units"), target).groupBy("r1", "r2").agg(F.count("*").alias("copies"))
    r1, r2 = _keys()
    # All columns as one, so that no name can clash.
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record"), r1.alias("r1"), r2.alias("r2"))
    often = rows.join(copies, ["r1", "r2"]).select(
        "record", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    )
    return often.select("record.*")
