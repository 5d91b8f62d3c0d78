"""Column contracts of the stages, checked where a stage begins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPLITS = ("train", "validation", "test")

KEEP_TRIPLE = ("original_text", "rewritten_text", "rewrite_prompt", "source")

EXAMPLE = T.StructType(
    [
        T.StructField("original_text", T.StringType()),
        T.StructField("rewritten_text", T.StringType()),
        T.StructField("rewrite_prompt", T.StringType()),
    ]
)

RAW_TEXTS = T.StructType(
    [
        T.StructField("original_text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("original_length", T.IntegerType()),
        T.StructField("corpus", T.StringType()),
    ]
)

GATHERED = T.StructType(
    [
        T.StructField("original_text", T.StringType()),
        T.StructField("rewritten_text", T.StringType()),
        T.StructField("rewrite_prompt", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("yes", T.DoubleType()),
        T.StructField("most_likely_label", T.StringType()),
        T.StructField("prompt_source", T.StringType()),
        T.StructField("prompt_cluster", T.IntegerType()),
    ]
)

SCORED = T.StructType(
    [
        T.StructField("original_text", T.StringType()),
        T.StructField("rewritten_text", T.StringType()),
        T.StructField("rewrite_prompt", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("predicted", T.ArrayType(T.StringType())),
        T.StructField("cosine", T.ArrayType(T.DoubleType())),
        T.StructField("cosine_3", T.ArrayType(T.DoubleType())),
    ]
)

PAIRS = (
    "id",
    "original_text",
    "rewritten_text",
    "rewrite_prompt",
    "source",
    "chosen",
    "rejected",
    "version",
)


def require(df: DataFrame, schema: T.StructType, stage: str) -> DataFrame:
    """Fail early, on the driver, when a stage is fed the wrong columns."""
    have = {field.name: field.dataType for field in df.schema}
    wrong = [
        f"{field.name}: want {field.dataType.simpleString()}, "
        f"have {have[field.name].simpleString() if field.name in have else 'nothing'}"
        for field in schema
        if field.name not in have or have[field.name].simpleString() != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"{stage}: " + "; ".join(wrong))
    return df


def keep(df: DataFrame, columns) -> DataFrame:
    """Whitelist projection; a missing column is an error, extra ones are dropped."""
    return df.select(*columns)
