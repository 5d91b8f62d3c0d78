"""Text vectors with inverse document frequencies, k-means clusters and nearest centres."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.fixed import CLUSTER_SEED, CLUSTERS
from quillwork.functions.hashing import digest
from quillwork.functions.vectors import CENTRE_BYTES, closest, matrix, nearest

TEXT_DIGITS = 2  # 16**2 = 256 buckets
ROUNDS = 20
#: Vectors that meet a block of centres together.
PACKED_ROWS = 4096
PACKED = "rows binary, vectors binary, distance binary, number binary"


# -- text vectors -----------------------------------------------------------


def text_buckets(text_col: str, digits: int = TEXT_DIGITS) -> Column:
    """The bucket of each lower-case token: the leading hex digits of its MD5. A null text has none."""
    tokens = F.transform(F.split(F.lower(text_col), " ", -1), lambda t: F.substring(F.md5(t), 1, digits))
    return F.coalesce(tokens, F.array().cast("array<string>"))


def bucket_names(digits: int = TEXT_DIGITS) -> list[str]:
    return [f"{number:0{digits}x}" for number in range(16**digits)]


def fit_text_weights(df: DataFrame, text_col: str, digits: int = TEXT_DIGITS) -> list[float]:
    """Inverse document frequency of every bucket: ln((texts + 1) / (texts with it + 1)).

    One pass; an empty name that every text holds counts the texts. At most one
    row a bucket reaches the driver.
    """
    held = F.concat(F.array(F.lit("")), F.array_distinct(text_buckets(text_col, digits)))
    counts = dict(map(tuple, df.select(F.explode(held).alias("bucket")).groupBy("bucket").count().collect()))
    return [math.log((counts.get("", 0) + 1) / (counts.get(name, 0) + 1)) for name in bucket_names(digits)]


def with_text_vector(
    df: DataFrame, text_col: str, out_col: str = "embeddings", weights: list[float] | None = None, digits: int = TEXT_DIGITS
) -> DataFrame:
    """A unit-length vector of token counts by bucket, weighted if weights are given; built in the JVM.

    Stands in where no sentence encoder is given; any scorer that returns an
    array column takes its place.
    """
    told = df.withColumn("_buckets", text_buckets(text_col, digits))
    out = CountVectorizerModel.from_vocabulary(bucket_names(digits), "_buckets", "_counts").transform(told)
    if weights is not None:
        out = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted").transform(out)
    unit = Normalizer(inputCol="_counts" if weights is None else "_weighted", outputCol="_unit").transform(out)
    return unit.withColumn(out_col, vector_to_array("_unit", "float32")).select(*[c for c in df.columns if c != out_col], out_col)


def text_embedder(weights: list[float], digits: int = TEXT_DIGITS) -> Callable[[DataFrame, str, str], DataFrame]:
    """An embedder with fixed weights, so that vectors of different frames can be compared."""
    return lambda df, text_col, out_col: with_text_vector(df, text_col, out_col, weights, digits)


# -- k-means ----------------------------------------------------------------


@dataclass(frozen=True)
class Clusters:
    """Fitted centres, one row each, and the rounds it took."""

    centres: np.ndarray
    rounds: int

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)


def _start(vectors: DataFrame, k: int, order: Column) -> np.ndarray:
    """The ``k`` distinct vectors with the smallest digests."""
    firsts = vectors.select("v", order.alias("d")).groupBy("v").agg(F.min("d").alias("d")).orderBy("d").limit(k)
    return np.array([row["v"] for row in firsts.collect()], np.float64)


def _sums(vectors: DataFrame, centres: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors per centre and their sums in fixed point: whole numbers, so in any order the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), centres.shape[1] + 1), np.int64)
        for batch in batches:
            rows = matrix(batch.column(0))
            if len(rows):
                at = closest(rows, centres)[1]
                np.add.at(total, at, np.column_stack([np.ones(len(rows), np.int64), np.rint(np.ldexp(rows, bits)).astype(np.int64)]))
        cluster, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[cluster, place])], names=["c", "p", "n"]
        )

    out = np.zeros((len(centres), centres.shape[1] + 1), np.int64)
    for row in vectors.select("v").mapInArrow(run, "c int, p int, n long").groupBy("c", "p").agg(F.sum("n")).collect():
        out[row[0], row[1]] = row[2]
    return out[:, 0], out[:, 1:]


def fit_clusters(
    df: DataFrame, vector_col: str = "embeddings", k: int = CLUSTERS, seed: int = CLUSTER_SEED, key: list[str] | None = None,
    rounds: int = ROUNDS,
) -> Clusters:
    """K-means over an array column: Lloyd's rounds from ``k`` distinct vectors drawn by a digest of the rows' key.

    Distances that agree to nine decimals are ties, which the first centre wins; sums are in fixed point. So the
    same rows give the same centres, whatever partitions they lie in. Without ``key`` the
    digest is that of the vector. A centre without vectors stays where it is; rounds end when no centre moves.
    What reaches the driver is k centres a round. Write ``df`` first if its vectors are dear.
    """
    vectors = df.where(F.col(vector_col).isNotNull()).select(F.col(vector_col).alias("v"), *(key or []))
    top = F.max(F.greatest(F.array_max("v"), -F.array_min("v")))
    size = vectors.agg(F.count("*").alias("n"), top.alias("top")).first()
    if size["n"] == 0:
        raise ValueError("no vectors to cluster")
    order = digest(f"centre|{seed}", *key) if key else digest(f"centre|{seed}", F.to_json(F.struct("v")))
    bits = min(40, 61 - math.ceil(math.log2(size["n"] * max(size["top"] or 0.0, 2.0**-60) + 1)))
    centres = _start(vectors, k, order)
    for done in range(rounds):
        counts, sums = _sums(vectors, centres, bits)
        moved = np.where(counts[:, None] > 0, np.ldexp(sums.astype(np.float64), -bits) / np.maximum(counts, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            return Clusters(centres, done)
        centres = moved
    return Clusters(centres, rounds)


def with_cluster(df: DataFrame, model: Clusters, vector_col: str = "embeddings") -> DataFrame:
    """Adds the number of the nearest centre."""
    return df.withColumn("cluster", nearest(vector_col, model.centres.tolist()))


def centres_frame(spark: SparkSession, model: Clusters) -> DataFrame:
    """The k centres as (cluster, center) rows."""
    rows = [(number, center) for number, center in enumerate(model.centres.tolist())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def mean_vectors(df: DataFrame, by: str, vector_col: str = "embeddings") -> DataFrame:
    """The mean vector of each group as ``center``, combined before the shuffle."""
    means = df.groupBy(by).agg(Summarizer.mean(array_to_vector(vector_col)).alias("_mean"))
    return means.select(by, vector_to_array("_mean").alias("center"))


# -- nearest centre ---------------------------------------------------------


def with_nearest_centre(
    df: DataFrame, centres: DataFrame | list[list[float]], vector_col: str = "embeddings", out_col: str = "cluster"
) -> DataFrame:
    """Adds the nearest of given centres: a frame (cluster, center), or a list.

    A frame's centres stay in Spark, however many they are. Its clusters are cut into blocks of at most ``CENTRE_BYTES``
    by number; rows travel packed, some thousand to a value, past one broadcast block after
    another and keep the least distance so far. Distances that agree to nine
    decimals are a tie, which the smaller number wins; a null vector has no cluster, nor has any without centres.
    """
    if isinstance(centres, list):
        return df.withColumn(out_col, nearest(vector_col, centres))
    size = centres.agg(F.max("cluster").alias("last"), F.max(F.size("center")).alias("width")).first()
    if size["last"] is None:
        return df.withColumn(out_col, F.lit(None).cast("int"))
    kept = [c for c in df.columns if c != out_col]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out_col, T.IntegerType())])
    per_block = max(1, CENTRE_BYTES // (8 * size["width"] + 16))
    blocks = (
        centres.groupBy(F.expr(f"cluster div {per_block}").cast("int").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("cluster").cast("int").alias("cluster"), F.col("center").cast("array<double>").alias("center")))).alias("centres"))
    )
    packed = df.select(*kept).mapInArrow(_packing(vector_col), PACKED)
    last = size["last"] // per_block
    for block in range(last + 1):
        met = packed.withColumn("block", F.lit(block)).join(F.broadcast(blocks.where(F.col("block") == block)), "block", "left").drop("block")
        packed = met.mapInArrow(_passing, PACKED) if block < last else met.mapInArrow(_unpacking(out_col), schema)
    return packed


def _packing(vector_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PACKED_ROWS):
                part = batch.slice(begin, PACKED_ROWS)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as writer:
                    writer.write_batch(part)
                vectors = matrix(part.column(vector_col))
                far = np.full(len(vectors), np.inf)
                yield _packed(sink.getvalue().to_pybytes(), vectors.tobytes(), far, np.full(len(vectors), -1, np.int32))

    return run


def _packed(rows: bytes, vectors: bytes, distance: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    cells = [rows, vectors, distance.tobytes(), number.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["rows", "vectors", "distance", "number"])


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, vectors, distance, number, centres in zip(*batch.columns):
            distance, number = (np.frombuffer(c.as_buffer(), t) for c, t in ((distance, np.float64), (number, np.int32)))
            if centres.is_valid and len(number):
                table, names = matrix(centres.values.field("center")), centres.values.field("cluster").to_numpy()
                held = np.frombuffer(vectors.as_buffer(), np.float64).reshape(len(number), -1)
                if held.shape[1] not in (0, table.shape[1]):
                    raise ValueError("vectors of unequal length")
                if held.shape[1]:
                    near, at = closest(held, table)
                    nearer = near < distance  # false for the NaN of a null vector, and for ties with smaller numbers
                    distance, number = np.where(nearer, near, distance), np.where(nearer, names[at], number).astype(np.int32)
            yield _packed(rows.as_py(), vectors.as_py(), distance, number)


def _unpacking(out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _passing(batches):
            for rows, number in zip(batch.column("rows"), batch.column("number")):
                (part,) = pa.ipc.open_stream(rows.as_buffer())
                found = np.frombuffer(number.as_buffer(), np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, mask=found < 0)], names=[*part.schema.names, out_col])

    return run
