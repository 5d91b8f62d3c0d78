"""Splits, balanced prompt draws and few-shot draws."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.fixed import PROMPTS_PER_TEXT, SPLIT_SHARES
from quillwork.functions.hashing import digest, uniform, uniform_index
from quillwork.operators.joins import BROADCAST_BOUND, Size, SizeBound, lookup_join, measure, measure_by
from quillwork.operators.ranking import BUCKET_DIGITS, same_key, with_group_index
from quillwork.schemas import SPLITS


def split_of(*key, seed=42, shares=SPLIT_SHARES) -> Column:
    """Random split name of a row, by shares, from its key alone."""
    u = uniform(digest(f"split|{seed}", *key))
    edge = 0.0
    chosen = None
    for name, share in shares[:-1]:
        edge += share
        limit = u < F.lit(round(edge, 12))
        chosen = F.when(limit, F.lit(name)) if chosen is None else chosen.when(limit, F.lit(name))
    last = F.lit(shares[-1][0])
    return last if chosen is None else chosen.otherwise(last)


def choice(n: int, *key, salt) -> Column:
    """Uniform choice of one of ``n`` templates for a row."""
    return uniform_index(digest(salt, *key), n).cast("int")


def bypassed(probability: float, *key, salt) -> Column:
    """True for a share of the rows: those that skip labelling."""
    return uniform(digest(f"bypass|{salt}", *key)) < F.lit(float(probability))


def requested_splits(split: str) -> tuple[str, ...]:
    """The splits a job was asked for; ``all`` is every one of them."""
    if split == "all":
        return SPLITS
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}; use one of {', '.join(SPLITS)}, all")
    return (split,)


def source_weights(prompts: DataFrame) -> DataFrame:
    """Adds ``weight``: inverse size of the prompt's source, normalised to sum 1.

    Sizes come from a map-side combined aggregate that is joined back; a window
    over the source would move a whole source into one task. Each source has
    total weight 1 / sources, so no second sum over all prompts is needed.
    """
    sizes = prompts.groupBy("source").agg(F.count("*").alias("_rows"))
    size = measure(sizes)
    n_sources = size.rows
    joined = lookup_join(prompts, sizes, ["source"], spread=["rewrite_prompt"], size=size)
    return joined.withColumn("weight", F.lit(1.0) / (F.lit(float(n_sources)) * F.col("_rows"))).drop("_rows")


@dataclass(frozen=True)
class PromptPool:
    """Prompts that can be drawn by (source number, place in source)."""

    prompts: DataFrame  # source_no, place, rewrite_prompt; with the drawn source: prompt_source, prompt_cluster too
    metadata: DataFrame | None  # rewrite_prompt, prompt_source, prompt_cluster: one row per source that holds the text
    sources: DataFrame  # source_no, in_source
    n_sources: int
    size: Size  # of the catalogue; none of the three frames has more rows or bytes


def prompt_pool(prompts: DataFrame, keep_drawn_source: bool = False) -> PromptPool:
    """Index prompts for balanced drawing, with the metadata each draw will get.

    A draw is joined to the metadata of every prompt with its text: a text held by
    k sources gives k rows. The two steps, place to text and text to metadata, stay
    apart: joined on the prompts they would be k * k rows. With
    ``keep_drawn_source`` a draw keeps only the metadata of the source it was drawn from.
    Prompts without a source or a text cannot be drawn and are left aside first.
    """
    if "cluster" not in prompts.columns:
        prompts = prompts.withColumn("cluster", F.lit(None).cast("int"))
    prompts = prompts.select("source", "rewrite_prompt", "cluster").where("source IS NOT NULL AND rewrite_prompt IS NOT NULL")
    size, n_sources = measure_by(prompts, "source")
    digits = 0 if size.fits() else BUCKET_DIGITS
    sources = with_group_index(
        prompts.groupBy("source").agg(F.count("*").alias("in_source")), [], ["source"], index_col="source_no",
        digits=digits,
    )
    placed = with_group_index(prompts, ["source"], ["rewrite_prompt"], index_col="place", digits=digits)
    drawn = lookup_join(
        placed, sources.select("source", "source_no"), ["source"], spread=["rewrite_prompt"], size=size
    )
    sources = sources.select("source_no", "in_source")
    if keep_drawn_source:
        own = [F.col("source").alias("prompt_source"), F.col("cluster").alias("prompt_cluster")]
        return PromptPool(drawn.select("source_no", "place", "rewrite_prompt", *own), None, sources, n_sources, size)
    metadata = prompts.select(
        "rewrite_prompt", F.col("source").alias("prompt_source"), F.col("cluster").alias("prompt_cluster")
    )
    return PromptPool(drawn.select("source_no", "place", "rewrite_prompt"), metadata, sources, n_sources, size)


def draw_prompts(
    texts: DataFrame,
    pool: PromptPool,
    key: list[str],
    k: int = PROMPTS_PER_TEXT,
    seed=42,
    bound: SizeBound = BROADCAST_BOUND,
) -> DataFrame:
    """``k`` prompts per text, with replacement; every source is equally likely.

    One digest per draw gives the source (first half) and the place in that source
    (second half): the distribution of weights 1 / source size, as equi-joins. A
    small pool is broadcast and texts are never shuffled. A large pool is joined
    to the distinct keys of the draws alone, and each text then meets its finished
    draws. Both ways give the same rows: texts with equal keys draw alike, and a null is a key.
    """
    draw_no = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("draw_no")
    hashed = digest(f"draw|{seed}", *key, "draw_no")
    spread = [*key, "draw_no"]
    small = pool.size.fits(bound)
    base = texts if small else texts.select(*key).distinct()
    draws = (
        base.select("*", draw_no)
        .withColumn("_digest", hashed)
        .withColumn("source_no", uniform_index(F.col("_digest"), pool.n_sources, 0))
    )
    draws = lookup_join(draws, pool.sources, ["source_no"], spread, bound=bound, size=pool.size if small else None)
    draws = draws.withColumn("place", uniform_index(F.col("_digest"), F.col("in_source"), 1))
    drawn = lookup_join(draws, pool.prompts, ["source_no", "place"], spread, bound=bound, size=pool.size)
    if pool.metadata is not None:
        drawn = lookup_join(drawn, pool.metadata, ["rewrite_prompt"], spread, bound=bound, size=pool.size)
    drawn = drawn.drop("_digest", "source_no", "in_source", "place")
    fields = ["draw_no", "rewrite_prompt", "prompt_source", "prompt_cluster"]
    if small:
        return drawn.select(*texts.columns, *fields)
    lists = drawn.groupBy(*key).agg(F.collect_list(F.struct(*fields)).alias("_draws"))
    return _with_finished(texts, lists, key).select(*texts.columns, F.inline("_draws"))


def _with_finished(rows: DataFrame, lists: DataFrame, key: list[str]) -> DataFrame:
    """Rows with what was drawn for their key; nulls are keys too."""
    return rows.join(lists.withColumnsRenamed({c: f"_of_{c}" for c in key}), same_key(key))


def attach_examples(
    rows: DataFrame,
    pool: DataFrame,
    key: list[str],
    pool_key: list[str],
    k: int = 1,
    seed=0,
    bound: SizeBound = BROADCAST_BOUND,
) -> DataFrame:
    """Adds ``examples``: ``k`` examples of the pool per row, drawn with replacement.

    Draws are equi-joined to the pool's dense index; the index is uniform, so no
    key is hot. A small pool is broadcast, and the rows are never shuffled. A pool
    beyond the bound is shuffled on that index, and the finished example lists
    (``k`` entries) are joined to the rows by key. The pool is read several times;
    materialise it first if it is dear.
    """
    fields = ["original_text", "rewritten_text", "rewrite_prompt"]
    size = measure(pool.select(*fields))
    if size.rows == 0:
        raise ValueError("the example pool is empty")
    digits = 0 if size.fits(bound) else BUCKET_DIGITS
    indexed = with_group_index(pool, [], pool_key, index_col="_place", digits=digits).select("_place", *fields)
    salt = f"example|{seed}"
    if size.fits(bound):
        # one frame for all draws, so that it is sent once
        named = indexed.select("_place", F.struct(*fields).alias("_example"))
        joined = rows
        for draw in range(k):
            place = uniform_index(digest(salt, *key, F.lit(draw)), size.rows)
            joined = joined.withColumn("_wanted", place).join(F.broadcast(named), F.col("_wanted") == F.col("_place"))
            joined = joined.withColumnRenamed("_example", f"_example{draw}").drop("_wanted", "_place")
        examples = F.array(*[F.col(f"_example{draw}") for draw in range(k)])
        return joined.withColumn("examples", examples).select(*rows.columns, "examples")
    draws = (
        rows.select(*key).distinct().select(*key, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_draw"))
        .withColumn("_place", uniform_index(digest(salt, *key, F.col("_draw")), size.rows))
    )
    drawn = lookup_join(draws, indexed, ["_place"], [*key, "_draw"], bound=bound, size=size)
    lists = drawn.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_draw", *fields))).alias("_drawn"))
    examples = F.transform("_drawn", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return _with_finished(rows, lists, key).withColumn("examples", examples).select(*rows.columns, "examples")
