"""Chosen / rejected pairs from scored candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.functions.arrays import argmax, element
from quillwork.operators.ranking import with_group_index
from quillwork.schemas import PAIRS


def unpaired(df: DataFrame) -> DataFrame:
    """Rows by version and split, and how many of them have no best candidate or no second one."""
    alone = argmax("cosine").isNull() | (F.coalesce(F.size("predicted"), F.lit(0)) < 2)
    return df.groupBy("version", "split").agg(F.count("*").alias("rows"), F.sum(alone.cast("bigint")).alias("unpaired"))


def preference_pairs(df: DataFrame, key: list[str]) -> DataFrame:
    """Every candidate but the best against the best: m - 1 pairs for m candidates.

    ``id`` numbers the rows of a (version, split); it is 0-based and the same on
    every run. With (version, split) it is unique. ``key`` identifies an input row; rows
    that it does not tell apart must be equal. Rows without a best candidate (a null or
    empty list, or scores that are all null) give no pair; ``unpaired`` counts them.
    """
    indexed = with_group_index(df, ["version", "split"], key, index_col="id")
    best = indexed.withColumn("best", argmax("cosine")).withColumn("chosen", element("predicted", "best"))
    exploded = best.select("*", F.posexplode("predicted").alias("count", "rejected"))
    return exploded.where(F.col("count") != F.col("best")).select(*PAIRS, "split")
