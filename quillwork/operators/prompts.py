"""The prompt catalogue and joins against it."""

from __future__ import annotations

import json
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.fixed import CATALOGUE
from quillwork.operators.joins import lookup_join


def generated_prompts(spark: SparkSession) -> DataFrame:
    """Every value in every template of its family, as (source, rewrite_prompt).

    One row per template carries its family's values as an array; exploding that
    array gives the product without a join.
    """
    rows = []
    for family, (words, templates) in CATALOGUE.items():
        for template in templates:
            (head, _, _, _), *rest = Formatter().parse(template)
            rows.append({"source": family, "head": head, "tail": rest[0][0] if rest else "", "words": words})
    schema = "array<struct<source: string, head: string, tail: string, words: array<string>>>"
    literal = F.from_json(F.lit(json.dumps(rows)), schema)  # one constant, folded by the optimizer
    table = spark.range(0, 1, 1, 1).select(F.inline(literal))
    return table.select("source", "head", "tail", F.explode("words").alias("word")).select(
        "source", F.concat("head", "word", "tail").alias("rewrite_prompt")
    )


def distinct_prompts(*frames: DataFrame) -> DataFrame:
    """Union by name, then one row per (source, rewrite_prompt)."""
    union = frames[0].select("source", "rewrite_prompt")
    for frame in frames[1:]:
        union = union.unionByName(frame.select("source", "rewrite_prompt"))
    return union.dropDuplicates(["source", "rewrite_prompt"])


def with_prompt_metadata(texts: DataFrame, prompts: DataFrame, spread: list[str]) -> DataFrame:
    """Inner join on the prompt text; adds prompt_source and prompt_cluster.

    Prompts are unique per (source, text) only: a prompt held by k sources gives
    each of its texts k rows, and these are kept.
    """
    metadata = prompts.select(
        "rewrite_prompt", F.col("source").alias("prompt_source"), F.col("cluster").alias("prompt_cluster")
    )
    return lookup_join(texts, metadata, ["rewrite_prompt"], spread=spread)
