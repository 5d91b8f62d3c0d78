"""Array functions for candidate lists and their scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    Catalyst substitutes a column wherever it is used, so a value used n times in
    an expression that is itself used n times grows as a power. A lambda binds it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def argmax(scores) -> Column:
    """0-based position of the first maximum; NaN counts as the largest value."""
    scores = _column(scores)
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def element(values, index) -> Column:
    """Element at a 0-based position, null outside the array."""
    return F.get(_column(values), _column(index))


def regroup(values, n: int) -> Column:
    """Cut one flat array into arrays of ``n``, the last one padded with nulls."""
    values = _column(values)
    groups = F.greatest(F.ceil(F.size(values) / F.lit(n)).cast("int"), F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(0), groups - 1),
        lambda i: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.get(values, i * n + j)),
    )
    return F.when(F.size(values) == 0, F.slice(cut, 1, 0)).otherwise(cut)


def array_sum(values) -> Column:
    return F.aggregate(_column(values), F.lit(0.0), lambda acc, x: acc + x)


def array_stddev_pop(values) -> Column:
    """Population standard deviation (divides by n, not n - 1), in one pass; null for an empty array."""

    def step(acc, x):
        n = acc["n"] + 1
        mean = acc["mean"] + (x - acc["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (acc["m2"] + (x - acc["mean"]) * (x - mean)).alias("m2"))

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(_column(values), start, step, lambda acc: F.sqrt(F.try_divide(acc["m2"], acc["n"])))
