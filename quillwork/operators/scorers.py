"""The contract for models: batch functions over Arrow batches.

A scorer is set up once per task, called on batches of its input columns alone,
and cleaned up when the task ends. The other columns stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class BatchScorer(Protocol):
    def setup(self) -> None: ...

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame: ...

    def cleanup(self) -> None: ...


class FunctionScorer:
    """A plain function as a scorer without set-up."""

    def __init__(self, function):
        self.function = function

    def setup(self) -> None:
        pass

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        return self.function(batch)

    def cleanup(self) -> None:
        pass


def score_column(scorer: BatchScorer, schema: str, batch_size: int = 64, repeatable: bool = True):
    """A function from input columns to one struct column of the scorer's outputs."""

    @F.pandas_udf(schema)
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer.setup()
        try:
            for frame in frames:
                pieces = [
                    scorer(frame.iloc[at : at + batch_size].reset_index(drop=True))
                    for at in range(0, len(frame), batch_size)
                ]
                yield pd.concat(pieces, ignore_index=True) if pieces else scorer(frame)
        finally:
            scorer.cleanup()

    if not repeatable:
        score = score.asNondeterministic()

    def apply(**inputs: Column | str) -> Column:
        columns = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in inputs.items()]
        return score(F.struct(*columns))

    return apply


def rescored_column(scorer: BatchScorer, output: str, threshold: float, batch_size: int = 64):
    """A function from input columns to a struct (first, second) of two scores, in one pass.

    The scorer is set up once per task. Rows whose ``text`` is null are not scored. Only rows that score above
    ``threshold`` are scored again, with the second inputs in place of those of the same name; they
    are gathered, so that a batch is full before the scorer sees it.
    """

    @F.pandas_udf("struct<first: double, second: double>")
    def score(first: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer.setup()

        def scores(rows: pd.DataFrame) -> pd.Series:
            told = rows[rows["text"].notna()]
            parts = [
                scorer(told.iloc[at : at + batch_size].reset_index(drop=True))[output] for at in range(0, len(told), batch_size)
            ]
            out = pd.Series(float("nan"), index=rows.index)
            if parts:
                out.loc[told.index] = pd.concat(parts).to_numpy(dtype=float, na_value=float("nan"))
            return out

        try:
            for frame in first:
                names = [c for c in frame.columns if not c.startswith("again_")]
                p = scores(frame[names])
                above = frame[p > threshold]
                again = pd.DataFrame({n: above[f"again_{n}" if f"again_{n}" in frame else n] for n in names}, index=above.index)
                yield pd.DataFrame({"first": p, "second": scores(again).reindex(frame.index)})
        finally:
            scorer.cleanup()

    score = score.asNondeterministic()

    def apply(inputs: dict[str, Column | str], again: dict[str, Column | str]) -> Column:
        columns = [*inputs.items(), *((f"again_{name}", c) for name, c in again.items())]
        return score(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns]))

    return apply


def with_scores(
    df: DataFrame, scorer: BatchScorer, inputs: dict[str, Column | str], schema: str, batch_size: int = 64,
    repeatable: bool = True,
) -> DataFrame:
    """Adds the scorer's output columns; a column of the same name is replaced.

    Scores of a model that is not repeatable should be written (``materialise``)
    before they are used twice.
    """
    column = score_column(scorer, schema, batch_size, repeatable)(**inputs)
    scored = df.withColumn("_scores", column)
    outputs = scored.schema["_scores"].dataType.names
    kept = [c for c in df.columns if c not in outputs]
    return scored.select(*kept, *[F.col("_scores")[name].alias(name) for name in outputs])
