"""Mixing sources to target weights.

Words are totalled per source, sources get targets by water-filling, and each
document is taken floor(rate) times plus once more with a probability of the
fraction, decided by a hash of its id, its text's digest, and its number among rows
with equal ones, so rows that share an id, or have none, draw apart. All sums are whole numbers, so a rerun on
any number of partitions takes the same documents.

Defined results: a null text has size 0 and is taken as often as any other of its
source; null sources form one source, which sorts last; of rows with equal id and text each draws for itself; an
empty table gives an empty table; texts are read whole, whatever their length; columns of the input other than the named ones
are never read by ``mixing_rates`` and are all kept by ``mix``, whatever they are called; a source whose texts have no word
has target 0 and is not taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillwork.llm.common import digest_uniform, table
from quillwork.operators.joins import lookup_join
from quillwork.operators.ranking import with_group_index
from quillwork.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
CAP = 2
SPACE = " \t\n\x0b\x0c\r"


def word_size(text: Column) -> Column:
    """Number of maximal runs without space or control white space; 0 for null."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def source_totals(sizes: DataFrame) -> DataFrame:
    """(source, source_size, place): places count from 0 by code point, null last.

    The sort is by ranges, and only the number of sources per range is summed up
    in one place, so a very large number of sources does not meet in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = materialise(
        totals.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .sortWithinPartitions(F.col("source").isNull(), F.col("source"))
        .withColumn("_range", F.spark_partition_id()),
        "sources",
    )
    before = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(F.col("source").isNull(), F.col("source")))
    return ranged.withColumn("_inside", inside - 1).join(F.broadcast(before), "_range").select(
        "source", "source_size", (F.col("_before") + F.col("_inside")).alias("place")
    )


def water_level(totals: DataFrame, cap: int = CAP, share: tuple[int, int] = SHARE) -> float:
    """The words that one unit of weight gets once no target is above ``cap`` times its source.

    Each round shares what capped sources leave among the others and caps those
    above; a round is one aggregate to a row, and there are as many as sets that get capped.
    """
    level, capped_before = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.lit(cap) * F.col("source_size")
        row = totals.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)).alias("capped"),
            F.sum(F.when(over, 1).otherwise(0)).alias("n"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if row["all"] is None or row["free"] == 0 or row["n"] == capped_before:
            return level
        capped_before = row["n"]
        level = (share[0] * row["all"] / share[1] - cap * row["capped"]) / row["free"]


def mixing_rates(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    cap: int = CAP,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, rate, copies."""
    given = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), word_size(F.col(text_column)).alias("size"),
        _who(F.col(id_column), F.col(text_column)).alias("who"),
    )
    sizes = _numbered(materialise(given, "sizes"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    totals = materialise(source_totals(sizes).withColumn("weight", weight), "targets")
    level = water_level(totals, cap, share)
    targets = totals.select(
        F.col("source").alias("_source"),
        "source_size",
        F.least(F.lit(level) * F.col("weight"), (F.lit(cap) * F.col("source_size")).cast("double")).alias("target"),
    )
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    # written totals have a known size: Spark broadcasts them below its own threshold and else splits skewed keys
    return (
        sizes.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("rate", rate)
        .select(
            "doc_id", "size", "source", "source_size", "target", "rate",
            _copies(F.col("rate"), seed).cast("long").alias("copies"),
        )
    )


def mix(
    docs: DataFrame, seed: int = 0, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, its copies numbered in ``copy``.

    The draw is made beside the row, so texts are not shuffled but for those of repeated rows. ``copy`` replaces a
    column of that name. Columns are numbered meanwhile, so no name of the caller's can clash.
    """
    columns = [c for c in docs.columns if c != "copy"]
    names = {c: f"c{k}" for k, c in enumerate(columns)}
    rates = mixing_rates(docs, seed=seed, id_column=id_column, text_column=text_column, source_column=source_column, **options)
    by_source = materialise(rates.groupBy("source").agg(F.max("rate").alias("rate")), "rates").withColumnRenamed("source", "of")
    rows = docs.select(*columns).toDF(*names.values())
    numbered = _numbered(rows.withColumn("who", _who(F.col(names[id_column]), F.col(names[text_column]))))
    drawn = numbered.join(by_source, F.col(names[source_column]).eqNullSafe(F.col("of"))).withColumn("copies", _copies(F.col("rate"), seed)).where("copies > 0")
    taken = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col(name).alias(c) for c, name in names.items()], "copy")


def _who(doc_id: Column, text: Column) -> Column:
    """One value for a row's id and text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|"), F.coalesce(F.md5(text), F.lit("-"))))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``nth``: the row's number, from 0, among those with its ``who``.

    Only rows that have an equal are shuffled, found by a map-side combined count.
    """
    several = materialise(rows.groupBy("who").agg(F.count("*").alias("n")).where("n > 1").select("who", F.lit(True).alias("several")), "several")
    if several.limit(1).count() == 0:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    marked = lookup_join(rows, several, ["who"], spread=["who"], how="left")
    single = marked.where("several IS NULL").drop("several").withColumn("nth", F.lit(0).cast("long"))
    equal = materialise(marked.where("several").drop("several"), "equal")
    return single.unionByName(with_group_index(equal, ["who"], ["who"], index_col="nth"))


def _copies(rate: Column, seed: int) -> Column:
    more = digest_uniform(seed, "mix", F.concat("who", F.lit("|"), F.col("nth").cast("string"))) < rate - F.floor(rate)
    return (F.floor(rate) + more.cast("int")).cast("int")


def op3_source_mix(spark, sf_dir: str) -> DataFrame:
    rates = mixing_rates(table(spark, sf_dir, "documents"))
    return rates.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5(COALESCE(doc_id::VARCHAR, 'null') || '|' || COALESCE(md5(text), '-')) AS who,
           row_number() OVER (PARTITION BY doc_id, text) - 1 AS nth
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, 2.0::DOUBLE * source_size / weight AS full_at,
           row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, encode(source) NULLS LAST) AS place
    FROM totals
), summed AS (
    SELECT *, sum(source_size) OVER (ORDER BY place)::BIGINT - source_size AS capped,
           sum(weight) OVER (ORDER BY place DESC)::BIGINT AS free, sum(source_size) OVER ()::BIGINT AS whole
    FROM ordered
), level AS (
    SELECT (3 * whole / 2.0::DOUBLE - 2 * capped) / free AS level
    FROM summed WHERE (3 * whole / 2.0::DOUBLE - 2 * capped) / free <= full_at ORDER BY place LIMIT 1
), targets AS (
    SELECT source, source_size, least(level * weight, 2.0::DOUBLE * source_size) AS target FROM totals, level
)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM (
    SELECT doc_id, size, source_size, target, COALESCE(target / nullif(source_size, 0), 0) AS rate,
           ('0x' || substr(md5('mix|0|' || who || '|' || nth), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
"""
