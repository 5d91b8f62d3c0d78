"""Positions, top-n and runs that never put a whole group into one task.

``row_number() over (partition by split)`` moves a third of all rows into one
task. Here a group is cut into buckets, each bucket is ranked on its own, and
the buckets are stitched together from one summary row per bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.functions.hashing import bucket, digest
from quillwork.schemas import SPLITS
from quillwork.session import materialise

BUCKET_DIGITS = 4  # 16**4 = 65,536 buckets per group: the summary of a group stays small
RUN_CHUNK = 1_000_000
#: Rows of one key that are still numbered together, and rows of a piece of a key with more.
CROWD, PIECE = 1_000_000, 1 << 17


def same_key(columns: list[str]) -> Column:
    """Null-safe equality of columns with those of the same names after ``_of_``."""
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns]
    return reduce(Column.__and__, same)


def with_group_index(
    df: DataFrame, groups: list[str], key: list[str], salt=0, index_col: str = "id", digits: int = BUCKET_DIGITS
) -> DataFrame:
    """0-based dense position of every row inside its group.

    The order is that of ``digest(key, salt)``, then ``key``; so it is the same on
    every run and for every partitioning. ``key`` must tell rows of a group apart, or
    rows that it does not tell apart must be equal; a null group is a group. The digest's leading digits are the
    bucket: buckets are equal in size, and ordered as the digests are. A key with more than ``CROWD`` rows
    would still meet in one bucket; its rows are written, cut into pieces as they lie, and numbered
    piece by piece. ``digits=0`` gives the same positions from one window per group; only for a frame that has
    been measured to be small.
    """
    salt = f"index|{salt}"
    if digits == 0:
        whole = Window.partitionBy(*groups).orderBy(digest(salt, *key), *key)
        return df.withColumn(index_col, (F.row_number().over(whole) - 1).cast("bigint"))
    keyed = df.withColumn("_digest", digest(salt, *key)).withColumn("_bucket", bucket(F.col("_digest"), digits))
    counts = materialise(keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_rows")), "buckets")
    columns = [*[c for c in df.columns if c != index_col], index_col]
    crowded = counts.where(F.col("_rows") > CROWD).select(*groups, "_bucket")
    if crowded.limit(1).count() == 0:
        return _numbered(keyed, counts, groups, ["_bucket"], key, index_col).select(*columns)
    # a key needs more than CROWD rows to be split, so there are fewer of them than rows / CROWD
    found = keyed.join(F.broadcast(_named(crowded)), same_key([*groups, "_bucket"]), "left_semi")
    repeated = materialise(found.groupBy(*groups, "_digest").agg(F.count("*").alias("_rows")).where(F.col("_rows") > CROWD), "repeated")
    split = keyed.join(F.broadcast(_named(repeated.select(*groups, "_digest", F.lit(True).alias("_split")))), same_key([*groups, "_digest"]), "left")
    split = split.drop(*[f"_of_{c}" for c in (*groups, "_digest")]).withColumnRenamed("_of__split", "_split")
    plain = split.where("_split IS NULL").withColumn("_piece", F.lit(0).cast("long"))
    pieces = materialise(split.where("_split"), "pieces").withColumn("_piece", F.expr(f"monotonically_increasing_id() div {PIECE}"))
    # whole buckets come in order; a split key is a bucket of its own behind the others that begin as it does
    every = plain.unionByName(pieces).withColumn("_part", F.when(F.col("_split"), F.col("_digest")).otherwise(F.substring("_digest", 1, 2 * digits)))
    level = ["_bucket", "_part", "_piece"]
    return _numbered(every, every.groupBy(*groups, *level).agg(F.count("*").alias("_rows")), groups, level, key, index_col).select(*columns)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: f"_of_{c}" for c in df.columns})


def _numbered(keyed: DataFrame, counts: DataFrame, groups: list[str], level: list[str], key: list[str], index_col: str) -> DataFrame:
    """Rows numbered inside each part of a group, plus the rows of the parts before."""
    earlier = Window.partitionBy(*groups).orderBy(*level).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, *level, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*groups, *level).orderBy("_digest", *key)
    return (
        keyed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(offsets.withColumnsRenamed({c: f"_of_{c}" for c in [*groups, *level]}), same_key([*groups, *level]))
        .withColumn(index_col, (F.col("_before") + F.col("_inside")).cast("bigint"))
    )


def sample_per_split(
    df: DataFrame, n: int, key: list[str], seed=0, splits=SPLITS, split_col: str = "split", digits: int = BUCKET_DIGITS
) -> DataFrame:
    """``min(n, rows)`` rows of each split, without replacement.

    A shuffle by digest and a limit per split, in two passes. The first counts
    rows per (split, bucket), reading only the key; it finds the bucket in which
    the n-th row of a split lies. The second keeps whole buckets before that one,
    unshuffled, and ranks the rows of that one alone: few of them, whatever n is.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    wanted = df.where(F.col(split_col).isin(*splits))
    keyed = wanted.withColumn("_digest", digest(f"sample|{seed}", *key)).withColumn("_bucket", bucket(F.col("_digest"), digits))
    so_far = Window.partitionBy(split_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        keyed.groupBy(split_col, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_to", F.sum("_rows").over(so_far))
        .where((F.col("_to") >= n) & (F.col("_to") - F.col("_rows") < n))
        .select(
            split_col, F.col("_bucket").alias("_cut"), (F.lit(n) - (F.col("_to") - F.col("_rows"))).alias("_room")
        )
    )
    # one row per split, so at most len(splits) rows are broadcast
    inside = Window.partitionBy(split_col, "_bucket").orderBy("_digest", *key)
    placed = keyed.join(F.broadcast(cuts), split_col, "left")
    whole = placed.where(F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")))
    edge = placed.where(F.col("_bucket") == F.col("_cut")).withColumn("_inside", F.row_number().over(inside))
    # the fixed bound lets every task drop what lies behind it before the shuffle, also where one key crowds the bucket
    kept = edge.where(F.col("_inside") <= n).where(F.col("_inside") <= F.col("_room"))
    return whole.select(*df.columns).unionByName(kept.select(*df.columns))


def with_runs(
    df: DataFrame,
    partition: list[str],
    position: str,
    value: str,
    run_col: str = "run",
    in_run_col: str = "count",
    chunk: int = RUN_CHUNK,
) -> DataFrame:
    """Number the runs of equal neighbouring values and the place inside each run.

    ``position`` is a non-negative integer, unique inside ``partition``. Runs count
    from 1 and places from 0; a null value always starts a run. A partition is cut
    into chunks of ``chunk`` positions; a run that crosses chunks is continued from
    the chunk summaries, one row per chunk.
    """
    keys = [*partition, "_chunk"]
    rows = Window.partitionBy(*keys).orderBy(position)
    local = (
        df.withColumn("_chunk", F.expr(f"`{position}` div {int(chunk)}"))
        .withColumn("_row", F.row_number().over(rows))
        .withColumn("_new", (F.col("_row") == 1) | F.coalesce(F.col(value) != F.lag(value).over(rows), F.lit(True)))
        .withColumn("_run", F.sum(F.col("_new").cast("bigint")).over(rows))
        .withColumn("_start", F.max(F.when(F.col("_new"), F.col("_row"))).over(rows))
    )
    summary = local.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.max("_run").alias("_runs"),
        F.max("_start").alias("_last_start"),
        F.min_by(value, F.col(position)).alias("_first"),
        F.max_by(value, F.col(position)).alias("_last"),
    )
    chunks = Window.partitionBy(*partition).orderBy("_chunk")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        summary.withColumn("_joined", F.coalesce(F.col("_first") == F.lag("_last").over(chunks), F.lit(False)))
        .withColumn("_rows_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_own_runs", F.col("_runs") - F.col("_joined").cast("bigint"))
        .withColumn("_runs_before", F.coalesce(F.sum("_own_runs").over(earlier), F.lit(0)))
        .withColumn(
            "_open_start",
            F.when(
                ~F.col("_joined") | (F.col("_runs") > 1), F.col("_rows_before") + F.col("_last_start")
            ),
        )
        .withColumn("_carried_start", F.last("_open_start", ignorenulls=True).over(earlier))
        .select(*keys, "_joined", "_rows_before", "_runs_before", "_carried_start")
    )
    start = F.when(F.col("_joined") & (F.col("_run") == 1), F.col("_carried_start")).otherwise(
        F.col("_rows_before") + F.col("_start")
    )
    return (
        local.join(stitched, keys)
        .withColumn(run_col, (F.col("_runs_before") + F.col("_run") - F.col("_joined").cast("bigint")).cast("bigint"))
        .withColumn(in_run_col, (F.col("_rows_before") + F.col("_row") - start).cast("bigint"))
        .select(*df.columns, run_col, in_run_col)
    )
