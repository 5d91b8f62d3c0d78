"""CSV sources of (original, rewritten, prompt) triples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.fixed import MISSING_CELLS
from quillwork.schemas import KEEP_TRIPLE


def missing_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cells that stand for "missing" become null, as a dataframe CSV reader has it."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*MISSING_CELLS), F.col(c)) for c in columns}
    )


def complete_rows(df: DataFrame, columns: Iterable[str] = KEEP_TRIPLE) -> DataFrame:
    return df.select(*columns).dropna("any")


def read_csv_sources(spark: SparkSession, sources: Iterable[tuple[str, str, list[str]]]) -> DataFrame:
    """All files of all (name, folder, files) sources as complete triples.

    Files are read one by one, since each has its own header, and united by name.
    Bag semantics: a file that is listed twice is read twice.
    """
    union = None
    for name, folder, files in sources:
        for file in files:
            frame = (
                spark.read.option("header", True)
                .option("multiLine", True)
                .option("quote", '"')
                .option("escape", '"')
                .csv(f"{folder}/{file}")
                .withColumn("source", F.lit(name))
                .withColumn("file", F.lit(file))
            )
            union = frame if union is None else union.unionByName(frame, allowMissingColumns=True)
    if union is None:
        raise ValueError("no files listed")
    texts = [c for c in KEEP_TRIPLE if c != "source"]
    return complete_rows(missing_to_null(union, texts))
