"""Row counts that a job gets from the pass that writes its rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, column: str, values: Iterable[str]) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its rows per value of ``column`` and in all (``rows``).

    The numbers are there once the frame has been written or otherwise run; no
    scan is made for them. ``values`` are those asked for; other rows count in ``rows`` alone.
    """
    seen = Observation()
    counts = [F.count_if(F.col(column) == value).alias(value) for value in values]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen
