"""Inputs for generators and the attachment of what they return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.fixed import EMPTY_GENERATION, REWRITE_TEMPLATES
from quillwork.functions.text import fill_one_of, instruction, or_empty, remove_echo
from quillwork.operators.ranking import same_key
from quillwork.operators.sampling import choice
from quillwork.operators.scorers import BatchScorer, with_scores


def with_generation_input(df: DataFrame, key: list[str], seed=0) -> DataFrame:
    """Adds ``rewrite_index`` (the template drawn for the row) and ``input``."""
    indexed = df.withColumn("rewrite_index", choice(len(REWRITE_TEMPLATES), *key, salt=f"template|{seed}"))
    prompt = fill_one_of(
        REWRITE_TEMPLATES,
        F.col("rewrite_index"),
        rewrite_prompt=or_empty("rewrite_prompt"),
        original_text="original_text",
    )
    return indexed.withColumn("input", instruction(prompt))


def stamp(df: DataFrame, model: str | None, params: dict, excluded=()) -> DataFrame:
    """Model and generation parameters as constant columns."""
    if model is not None:
        df = df.withColumn("model", F.lit(model))
    return df.withColumns({name: F.lit(value) for name, value in params.items() if name not in excluded})


def non_empty(df: DataFrame, column: str = "rewritten_text") -> DataFrame:
    """Drop failed generations; a null is not a failure mark and stays."""
    return df.where(~F.col(column).eqNullSafe(F.lit(EMPTY_GENERATION)))


def generate_texts(
    df: DataFrame,
    generator: BatchScorer,
    model: str,
    params: dict,
    batch_size: int = 8,
    echoes: bool = False,
    repeatable: bool = False,
) -> DataFrame:
    """Adds ``rewritten_text`` from a batch generator over ``input``, and the stamps.

    With ``echoes`` the input is cut out of what came back. Rows marked as failed
    are dropped.
    """
    out = with_scores(
        df, generator, {"input": "input"}, "struct<rewritten_text: string>", batch_size, repeatable=repeatable
    )
    if echoes:
        out = out.withColumn("rewritten_text", remove_echo("rewritten_text", "input"))
    return non_empty(stamp(out, model, params))


def generate_candidates(
    df: DataFrame, generator: BatchScorer, params: dict, batch_size: int = 2, repeatable: bool = False
) -> DataFrame:
    """Adds ``predicted``: the candidate answers of a row, and the stamps."""
    out = with_scores(
        df, generator, {"input": "input"}, "struct<predicted: array<string>>", batch_size, repeatable=repeatable
    )
    return stamp(out, None, params, excluded=("num_return_sequences", "pad_token_id"))


def attach_generations(df: DataFrame, generations: DataFrame, key: list[str], model: str, params: dict) -> DataFrame:
    """Adds ``rewritten_text`` from a table of finished generations, by row key; nulls are keys too.

    A row whose generation is missing keeps a null, which is no failure mark, and is
    counted by ``without_generation``. A key with several different generations is an error, found when the rows
    are read; equal ones are one.
    """
    finished = generations.groupBy(*key).agg(
        F.count_distinct("rewritten_text").alias("_kinds"), F.max("rewritten_text").alias("rewritten_text")
    )
    told = F.when(F.col("_kinds") > 1, F.raise_error(F.lit("a key has several generations"))).otherwise(F.col("rewritten_text"))
    unique = finished.select(*[F.col(c).alias(f"_of_{c}") for c in key], told.alias("rewritten_text"))
    kept = [c for c in df.columns if c != "rewritten_text"]
    return non_empty(stamp(df.select(*kept).join(unique, same_key(key), "left").select(*kept, "rewritten_text"), model, params))


def without_generation(df: DataFrame) -> DataFrame:
    """Number of rows that got no generation, as a one-row frame."""
    return df.agg(F.count_if(F.col("rewritten_text").isNull()).alias("missing"))


def regroup_rows(df: DataFrame, key: list[str], position: str, value: str, n: int, out_col: str = "group") -> DataFrame:
    """Flat answer rows to arrays of ``n``, the last one padded with nulls.

    Rows meet by (key, position // n), so a group has at most ``n`` rows however
    many answers a key holds. ``at`` numbers the arrays of a key.
    """
    member = F.col(position) % n
    places = [F.max(F.when(member == place, F.col(value))) for place in range(n)]
    return df.groupBy(*key, F.expr(f"`{position}` div {int(n)}").cast("int").alias("at")).agg(F.array(*places).alias(out_col))
