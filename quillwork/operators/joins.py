"""Joins against lookup tables whose size is measured, never assumed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.session import materialise


@dataclass(frozen=True)
class SizeBound:
    """What may be sent to every executor."""

    rows: int = 500_000
    bytes: int = 64 << 20


BROADCAST_BOUND = SizeBound()


def _value_bytes(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)).cast("bigint")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)).cast("bigint")
    return F.lit(8).cast("bigint")


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, bound: SizeBound = BROADCAST_BOUND) -> bool:
        return self.rows <= bound.rows and self.bytes <= bound.bytes


def _row_bytes(df: DataFrame) -> Column:
    return sum((_value_bytes(f.name, f.dataType) for f in df.schema), F.lit(0).cast("bigint"))


def measure(df: DataFrame) -> Size:
    """Rows and bytes of a frame: one distributed aggregate, one row to the driver."""
    row = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return Size(row["rows"], row["bytes"])


def measure_by(df: DataFrame, column: str) -> tuple[Size, int]:
    """Size of a frame and number of distinct values of a column, in one job."""
    groups = df.groupBy(column).agg(F.count("*").alias("n"), F.sum(_row_bytes(df)).alias("b"))
    row = groups.agg(
        F.count("*").alias("values"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"),
    ).first()
    return Size(row["rows"], row["bytes"]), row["values"]


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "inner",
    bound: SizeBound = BROADCAST_BOUND,
    size: Size | None = None,
) -> DataFrame:
    """Equi-join that broadcasts ``lookup`` if it is proven small, else deals the hot keys over a grid.

    ``spread`` names columns of ``big`` that tell its rows apart; they decide which
    copy of a hot key's lookup rows a row meets. ``how`` is inner or left. Rows are
    multiplied when a key occurs several times in ``lookup``, as in any join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    size = size or measure(lookup)
    if size.fits(bound):
        return big.join(F.broadcast(lookup), on, how)
    return salted_join(big, lookup, on, spread, how)


def salted_join(big: DataFrame, lookup: DataFrame, on: list[str], spread: list[str], how: str = "inner") -> DataFrame:
    """Shuffled equi-join in which a hot key is split over a grid of tasks.

    A key is hot when it holds more than its fair share (1 / shuffle partitions) of the rows of ``big``, of ``lookup``, or of
    the pairs; so there are fewer hot keys than three times the partitions, a bound that does not grow with the data. The
    rows that ``big`` has of a hot key are dealt over the rows of the grid and those of ``lookup`` over its columns, and each goes to
    all cells of its row or column: every pair meets in one cell. Counts are map-side combined aggregates over the keys.
    """
    spark = big.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the counts of keys are written, so that both sides are read once for them and their totals
    sides = big.groupBy(*on).agg(F.count("*").alias("_n"), F.lit(0).cast("long").alias("_m")).unionByName(
        lookup.groupBy(*on).agg(F.lit(0).cast("long").alias("_n"), F.count("*").alias("_m"))
    )
    counts = materialise(sides.groupBy(*on).agg(F.sum("_n").alias("_n"), F.sum("_m").alias("_m")), "counts")
    numbers = {"_n": F.col("_n").cast("double"), "_m": F.col("_m").cast("double"), "_pairs": F.col("_n").cast("double") * F.col("_m")}
    total = counts.agg(*[F.sum(v).alias(k) for k, v in numbers.items()]).first()
    share = {k: v / F.lit(max(total[k] or 0.0, 1.0)) for k, v in numbers.items()}
    crowded = F.greatest(*[s * parts for s in share.values()]) > 1
    rows, columns = F.ceil(share["_n"] * (2.0 * parts)), F.ceil(share["_m"] * (2.0 * parts))
    # pairs that are still too many for their cells are dealt over more of the grid's rows
    more = F.least(F.ceil(share["_pairs"] * (2.0 * parts) / F.greatest(columns, F.lit(1))), F.col("_n"))
    hot = counts.where(crowded & (F.col("_n") > 0)).select(
        *on, F.greatest(rows, more, F.lit(1)).cast("int").alias("_rows"), F.greatest(F.least(columns, F.col("_m")), F.lit(1)).cast("int").alias("_columns")
    )
    hot = F.broadcast(spark.createDataFrame(hot.collect(), hot.schema))  # fewer than 3 * parts rows
    # a null key meets nothing, so its rows may go anywhere
    no_key = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    ways = F.when(no_key, F.lit(parts)).otherwise(F.coalesce(F.col("_rows"), F.lit(1)))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1))

    dealt = [f.name for f in lookup.schema if isinstance(f.dataType, T.AtomicType)]
    left = big.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), ways).cast("int")).withColumn("_column", every("_columns"))
    right = (
        lookup.join(hot, on, "left").withColumn("_column", F.pmod(F.xxhash64(*dealt), F.coalesce(F.col("_columns"), F.lit(1))).cast("int"))
        .withColumn("_salt", every("_rows")).withColumn("_met", F.lit(True))
    )
    joined = left.drop("_rows").join(right.drop("_rows", "_columns"), [*on, "_salt", "_column"], how)
    # a key with several columns has a match in one of them, so what met nothing in another is no row
    real = joined.where(F.col("_met").isNotNull() | (F.coalesce(F.col("_columns"), F.lit(1)) == 1)) if how == "left" else joined
    return real.drop("_salt", "_column", "_columns", "_met")
