"""Draws with given weights, by an alias table that is built and read as Spark tables.

An alias table has one place per item. A place keeps its own item with a certain share and
else stands for one other item, so a draw is a uniform place and a coin: two equi-joins, whatever the weights are.
It is built without a sweep: items below the mean weight leave gaps, items above it have excess, and both are
laid end to end on one line by prefix sums. A gap is filled by the item on whose stretch it
begins, and an item passes on to the next what the last gap on its stretch took too much. All numbers are whole, so
every partitioning gives the same table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.fixed import PROMPTS_PER_TEXT
from quillwork.functions.hashing import digest, uniform, uniform_index
from quillwork.operators.joins import BROADCAST_BOUND, Size, SizeBound, lookup_join, measure
from quillwork.operators.ranking import BUCKET_DIGITS, same_key, with_group_index
from quillwork.session import materialise

CHUNK = 1 << 16
#: Weights become whole numbers of at most so many bits, relative to the largest.
WEIGHT_BITS = 30
WIDE = "decimal(38,0)"


def whole_weights(weights: Column, largest: float) -> Column:
    """Weights as whole numbers; one below a 2**30th of the largest rounds to nothing."""
    return F.round(weights / F.lit(largest) * F.lit(float(2**WEIGHT_BITS))).cast("long")


def _before(items: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all places before, by chunks and their sums."""
    chunked = items.withColumn("_chunk", F.expr(f"place div {CHUNK}")).withColumn("_value", value.cast(WIDE))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row a chunk
    sums = chunked.groupBy("_chunk").agg(F.sum("_value").cast(WIDE).alias("_sum"))
    offsets = sums.select("_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast(WIDE).alias("_offset"))
    inside = Window.partitionBy("_chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    summed = F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)).cast(WIDE)
    return chunked.join(offsets, "_chunk").withColumn(name, summed.cast(WIDE)).drop("_chunk", "_value", "_offset")


def _last_met(events: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the last ``value`` that is not null, at or before a row in the order.

    Rows are sorted by ranges; a range goes on from the last value of those before, one row a range.
    """
    ranged = materialise(events.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    lasts = ranged.where(F.col(value).isNotNull()).groupBy("_range").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    every = ranged.select("_range").distinct().join(lasts, "_range", "left")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_inside", inside).join(carried, "_range").withColumn(name, F.coalesce("_inside", "_carried")).drop("_inside", "_carried", "_range")


def alias_table(items: DataFrame) -> tuple[DataFrame, int]:
    """(place, share, alias) and the whole, for items (place, weight) with dense places from 0 and whole weights.

    A place keeps its own item with probability share / whole and is its alias else.
    Weights that are null, negative, or zero throughout are an error.
    """
    size = items.agg(F.count("*").alias("n"), F.sum("weight").alias("whole"), F.count_if(F.col("weight").isNull() | (F.col("weight") < 0)).alias("bad")).first()
    if size["bad"] or not size["whole"]:
        raise ValueError("weights must be known, none below zero and one above it")
    scaled = F.col("weight").cast(WIDE) * F.lit(size["n"]).cast(WIDE)
    gap = (F.lit(size["whole"]).cast(WIDE) - scaled).cast(WIDE)
    known = materialise(items.select("place", scaled.cast(WIDE).alias("scaled"), gap.alias("gap")), "weights")
    light = _before(known, F.greatest("gap", F.lit(0).cast(WIDE)), "begin").where("gap > 0")
    heavy = _before(known, F.greatest(-F.col("gap"), F.lit(0).cast(WIDE)), "begin").where("gap <= 0")
    none, order = F.lit(None), ["key", "kind", "place"]

    # a light place is filled by the last heavy one that begins at or before it
    begins = light.select(F.col("begin").alias("key"), F.lit(1).alias("kind"), "place", none.cast("long").alias("filler"), "scaled").unionByName(
        heavy.select(F.col("begin").alias("key"), F.lit(0).alias("kind"), "place", F.col("place").alias("filler"), "scaled")
    )
    filled = _last_met(begins, order, "filler", "alias").where("kind = 1").select("place", F.col("scaled").alias("share"), "alias")

    # a heavy place lacks what the last light one that begins before its end reaches beyond it; the next heavy one fills that
    end = F.col("begin") - F.col("gap")
    ends = heavy.select(end.cast(WIDE).alias("key"), F.lit(0).alias("kind"), "place", none.cast(WIDE).alias("reach")).unionByName(
        light.select(F.col("begin").alias("key"), F.lit(1).alias("kind"), "place", (F.col("begin") + F.col("gap")).cast(WIDE).alias("reach"))
    )
    over = F.greatest(F.coalesce(F.col("reached"), F.lit(0).cast(WIDE)) - F.col("key"), F.lit(0).cast(WIDE))
    short = _last_met(ends, order, "reach", "reached").where("kind = 0").select("place", (F.lit(size["whole"]).cast(WIDE) - over).cast(WIDE).alias("share"))
    places = heavy.select((-F.col("place")).alias("key"), F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"), "place")
    turned = places.withColumn("self", F.when(F.col("kind") == 1, F.col("place")))  # from the last place to the first
    after = _last_met(turned, order, "self", "next").where("kind = 0").select("place", "next")
    topped = short.join(after, "place").select("place", "share", F.coalesce("next", "place").alias("alias"))
    return filled.unionByName(topped), int(size["whole"])


@dataclass(frozen=True)
class WeightedPool:
    """Items that can be drawn by place, their alias table and its whole."""

    items: DataFrame
    table: DataFrame
    n: int
    whole: int
    size: Size


def weighted_pool(items: DataFrame, weight: str, key: list[str]) -> WeightedPool:
    """Index the items of a pool by ``key`` and build their alias table, written once. ``weight`` is any number."""
    size = measure(items)
    top = items.agg(F.max(F.col(weight).cast("double")).alias("top")).first()["top"]
    if not size.rows or top is None or not top > 0:
        raise ValueError("weights must be known, none below zero and one above it")
    placed = materialise(with_group_index(items, [], key, index_col="place", digits=0 if size.fits() else BUCKET_DIGITS), "pool")
    table, whole = alias_table(placed.select("place", whole_weights(F.col(weight), top).alias("weight")))
    return WeightedPool(placed, materialise(table.select("place", "share", "alias"), "aliases"), size.rows, whole, size)


def draw_weighted(
    texts: DataFrame, pool: WeightedPool, key: list[str], fields: dict[str, str], k: int = PROMPTS_PER_TEXT, seed=42,
    bound: SizeBound = BROADCAST_BOUND,
) -> DataFrame:
    """``k`` items per text, with replacement, each in proportion to its weight.

    Adds ``draw_no`` and the pool's columns that ``fields`` names, under the names it gives them; columns of the texts that are
    called so are replaced. One digest per draw gives the place and the coin. Texts with equal keys draw alike, and a null is a key. A small
    pool is broadcast and texts are not shuffled; for a large one the distinct draw keys alone meet it. Both give the same rows.
    """
    small = pool.size.fits(bound)
    kept = [c for c in texts.columns if c not in (*fields.values(), "draw_no")]
    base = texts.select(*kept) if small else texts.select(*key).distinct()
    spread = [*key, "draw_no"]
    draws = (
        base.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("draw_no"))
        .withColumn("_digest", digest(f"weighted|{seed}", *key, "draw_no"))
        .withColumn("_place", uniform_index(F.col("_digest"), pool.n, 0))
    )
    coin = uniform(F.col("_digest"), 1) * F.lit(float(pool.whole)) < F.col("_share").cast("double")
    table = pool.table.select(F.col("place").alias("_place"), F.col("share").alias("_share"), F.col("alias").alias("_alias"))
    met = lookup_join(draws, table, ["_place"], spread, bound=bound, size=pool.size)
    met = met.withColumn("_place", F.when(coin, F.col("_place")).otherwise(F.col("_alias"))).drop("_share", "_alias", "_digest")
    items = pool.items.select(F.col("place").alias("_place"), *[F.col(c).alias(name) for c, name in fields.items()])
    drawn = lookup_join(met, items, ["_place"], spread, bound=bound, size=pool.size).drop("_place")
    if small:
        return drawn.select(*kept, "draw_no", *fields.values())
    lists = drawn.groupBy(*key).agg(F.collect_list(F.struct("draw_no", *fields.values())).alias("_draws"))
    named = lists.withColumnsRenamed({c: f"_of_{c}" for c in key})
    return texts.join(named, same_key(key)).select(*kept, F.inline("_draws"))
