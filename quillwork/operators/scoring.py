"""Cosine scores of candidate answers and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.functions.arrays import array_stddev_pop, array_sum
from quillwork.functions.vectors import candidate_cosines, cosine, cosine_of_cubes


def with_candidate_scores(df: DataFrame, candidates="predicted_vectors", target="prompt_vector") -> DataFrame:
    """Adds the aligned arrays ``cosine`` and ``cosine_3``."""
    scored = df.withColumn("_scores", candidate_cosines(candidates, target))
    return scored.select(
        *df.columns, F.col("_scores")["cosine"].alias("cosine"), F.col("_scores")["cosine_3"].alias("cosine_3")
    )


def score_long(
    targets: DataFrame, candidates: DataFrame, key: list[str], target_col="target", candidate_col="candidate"
) -> DataFrame:
    """Scores in long form: candidates meet their row's target by an equi-join."""
    return candidates.join(targets, key).withColumns(
        {"cosine": cosine(candidate_col, target_col), "cosine_3": cosine_of_cubes(candidate_col, target_col)}
    )


def candidate_summary(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean over all scores, and mean over rows of the population spread.

    Row sums are added up, so score arrays are not exploded and both means
    combine before the shuffle.
    """
    return df.groupBy(*by).agg(
        F.try_divide(F.sum(array_sum("cosine")), F.sum(F.size("cosine"))).alias("cosine_avg"),
        F.avg(array_stddev_pop("cosine")).alias("cosine_std"),
    )


def similarity_summary(df: DataFrame, similarity: Column | str, by: list[str]) -> DataFrame:
    """Mean similarity and mean of its third power (which is not ``cosine_3``)."""
    similarity = F.col(similarity) if isinstance(similarity, str) else similarity
    return (
        df.withColumn("_s", similarity)
        .groupBy(*by)
        .agg(F.avg("_s").alias("similarity"), F.avg(F.col("_s") * F.col("_s") * F.col("_s")).alias("similarity_3"))
    )
