"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code has a bit per component, set where it is above zero, cut into segments of 16
bits. Codes are indexed by each segment's value. A round looks up the values that differ
from the query's in exactly r bits of a segment: two codes at most m(r+1)-1 bits
apart, m being the number of segments, are within r in one of them. The radius grows until a
query's k-th verified distance is covered so, and only open queries go on.

Equal codes are one index entry with the k+1 smallest ids, so very many equal vectors
are no hot bucket, and equal queries are searched once.

Defined results: a vector does not find itself; ties go to the smaller id; a null or
empty vector has no code, is not found and finds nothing; bits beyond a shorter
vector's end, and null components, are 0; rows with a null id are left aside; repeated rows are one vector;
with fewer than k others all are found; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillwork.llm.common import table
from quillwork.session import materialise

BITS = 16
WORD = 64
SALTS = 64
TOP = 10
EVERY = 50


def words_of(vector: Column, words: int) -> list[Column]:
    """The code as 64-bit words; a short vector's missing bits are 0."""

    def word(w: int) -> Column:
        bits = F.slice(vector, w * WORD + 1, WORD)
        value = F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1) + F.when(x > 0, 1).otherwise(0).cast("long"))
        return value.alias(f"c{w}")

    return [word(w) for w in range(words)]


def segment_of(prefix: str, number: int) -> Column:
    word, place = divmod(number, WORD // BITS)
    return F.shiftrightunsigned(F.col(f"{prefix}{word}"), BITS * place).bitwiseAND(F.lit((1 << BITS) - 1))


def distance(words: int) -> Column:
    return reduce(Column.__add__, [F.bit_count(F.col(f"q{w}").bitwiseXOR(F.col(f"c{w}"))) for w in range(words)])


def first_meeting(segments: int, radius: int) -> Column:
    """True where a pair is met for the first time: no segment is nearer, and none before this one is as near."""
    near = [F.bit_count(segment_of("q", s).bitwiseXOR(segment_of("c", s))) for s in range(segments)]
    nearest = F.least(*near) if segments > 1 else near[0]
    first = F.array_position(F.array(*near), F.lit(radius)) - 1
    return (nearest == radius) & (first == F.col("segment"))


def _ranked(rows: DataFrame, key: list[str], order: list[str], most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= most)


def index_codes(vectors: DataFrame, k: int, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame, int]:
    """(id, code) of every vector, (code, ids) of every distinct code with its k + 1 smallest ids, and the number of words."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector")).where("id IS NOT NULL AND size(vector) > 0")
    words = -(-(rows.agg(F.max(F.size("vector"))).first()[0] or 1) // WORD)
    padded = F.concat(F.col("vector").cast("array<double>"), F.array_repeat(F.lit(0.0), words * WORD))
    coded = materialise(rows.select("id", *words_of(padded, words)).distinct(), "codes")
    code = [f"c{w}" for w in range(words)]
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    few = _ranked(_ranked(salted, [*code, "salt"], ["id"], k + 1).drop("_rank"), code, ["id"], k + 1)
    entries = few.groupBy(*code).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return coded, materialise(entries, "entries"), words


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = TOP, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, distance): for each id of ``queries`` (one column, ids of vectors) its k nearest others.

    Of the codes met, the k + 1 with the least (distance, smallest id) are kept: any id of the
    answer is in one of them. A pair is met in several segments and rounds, and taken in the first alone.
    """
    coded, entries, words = index_codes(vectors, k, id_column, vector_column)
    segments = words * WORD // BITS
    code, query = [f"c{w}" for w in range(words)], [f"q{w}" for w in range(words)]
    asked = queries.select(F.col(queries.columns[0]).alias("id")).where("id IS NOT NULL").distinct()
    as_query = dict(zip(code, query))
    wanted = materialise(coded.join(asked, "id").withColumnsRenamed({"id": "query_id", **as_query}), "wanted")
    by_segment = F.posexplode(F.array(*[segment_of("c", s) for s in range(segments)])).alias("segment", "value")
    buckets = materialise(
        entries.select(*code, F.get("ids", F.lit(0)).alias("low"), F.size("ids").alias("n"), by_segment).repartition("segment", "value"), "buckets"
    )
    enough = min(k + 1, coded.count())
    open_ = materialise(wanted.select(*query).distinct(), "open")
    best = done = None
    for radius in range(BITS + 1):
        # one literal that is cut into numbers once; as single literals they would burden the driver's plan
        masks = ",".join(str(sum(1 << b for b in bits)) for bits in combinations(range(BITS), radius))
        own = F.posexplode(F.array(*[segment_of("q", s) for s in range(segments)])).alias("segment", "own")
        probes = open_.select(*query, own).withColumn("mask", F.explode(F.split(F.lit(masks), ",").cast("array<long>")))
        probes = probes.select(*query, "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        # the estimate of the probes' size does not see the explode, so Spark would send them to all tasks
        met = probes.hint("merge").join(buckets, ["segment", "value"]).where(first_meeting(segments, radius))
        rows = met.select(*query, *code, "low", "n", distance(words).alias("distance"))
        if best is not None:
            rows = rows.unionByName(best.join(open_, query).select(*rows.columns))
        best = materialise(_ranked(rows, query, ["distance", "low"], k + 1).drop("_rank"), "best")
        # the distance at which the ids met suffice; all codes within ``covered`` have been met
        covered = segments * (radius + 1) - 1
        upto = F.sum("n").over(Window.partitionBy(*query).orderBy("distance"))
        state = best.withColumn("upto", upto).where(F.col("upto") >= enough).groupBy(*query).agg(F.min("distance").alias("far"))
        closed = open_ if radius == BITS else state.where(F.col("far") <= covered).select(*query)
        part = best.join(closed, query)
        done = part if done is None else done.unionByName(part)
        open_ = materialise(open_.join(closed, query, "left_anti"), "open")
        if open_.limit(1).count() == 0:
            break
    ids = done.join(entries, code).select(*query, "distance", F.explode("ids").alias("id"))
    answers = wanted.join(ids, query).where("id != query_id")
    return _ranked(answers, ["query_id"], ["distance", "id"], k).select(
        "query_id", F.col("_rank").alias("rank"), "id", F.col("distance").cast("int").alias("distance")
    )


def op5_hamming_search(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0).select("vec_id"))


ORACLE_SQL = """
WITH pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id AS id,
           list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda x: ((x[1] > 0) != (x[2] > 0))::INTEGER))::INTEGER AS distance
    FROM embeddings q JOIN embeddings v ON q.vec_id % 50 = 0 AND q.vec_id != v.vec_id
)
SELECT query_id, rank::INTEGER AS rank, id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs) WHERE rank <= 10
"""
