"""Importance resampling toward a target distribution, ranked by regular sampling.

Runs of one to three words are hashed into buckets. What a bucket is worth follows from its
counts in the target and in the corpus; a document's weight is the sum over all its
runs, added up as arrays. A fixed number from the document's id (Gumbel noise) makes the highest
scores a draw without replacement in proportion to the weights.

The highest scores are found by parallel sorting with regular sampling. Each task
writes its rows as a sorted run. Rows at regular places of the runs give splitters, so
that no segment between two of them is much larger than another, whatever the scores are. The rows of a
segment come together from all runs and are merged there, and the number of rows in the segments
before gives exact ranks. Segments behind the last rank wanted are counted and not moved.

Defined results: a null or wordless text has no features, weight 0, and is never drawn;
a null id is hashed as "null" and comes last among equal scores; repeated rows are rows of their
own, ranked side by side; an empty target makes rare buckets worth more; an empty
table gives an empty table; other columns are not read. Very long texts are counted in pieces.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillwork.llm.common import slices, table
from quillwork.llm.decontamination import WORD_BYTES
from quillwork.session import materialise

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
SHARE = (5, 100)
SEED = 42
#: Bytes of a text whose words are held at once.
PIECE_BYTES = 1 << 20
#: Rows of a segment, and most samples that splitters are chosen from. With more runs than samples a
#: segment, segments are even on average only.
SEGMENT_ROWS = 1 << 16
SAMPLES = 1 << 20


def bucket_pieces(text: bytes, runs: int = LONGEST_RUN, buckets: int = BUCKETS, piece: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray]]:
    """(words, bucket of every run that ends in them), piece by piece of a text."""
    text = text.translate(WORD_BYTES)
    begin, held = 0, []
    while begin < len(text):
        end = text.find(b" ", begin + piece)
        end = len(text) if end < 0 else end
        words = held + text[begin:end].split()
        begin, before = end, len(held)
        spaced = [b" " + w for w in words]
        state = list(map(crc32, words))
        found = [state[before:]]
        for n in range(1, runs):
            state = list(map(crc32, spaced[n:], state))
            found.append(state[max(0, before - n) :])
        yield len(words) - before, np.concatenate([np.array(s, np.uint32) for s in found]) % buckets
        held = words[len(words) - runs + 1 :] if len(words) >= runs else words


def bucket_counts(texts: DataFrame, text_column: str = "text", runs: int = LONGEST_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts. A task adds up its rows; what comes to the driver is one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    for _, found in bucket_pieces(text.as_buffer().to_pybytes(), runs, buckets):
                        total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select(text_column).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    t, s = target.astype(np.float64), corpus.astype(np.float64)
    n = len(t)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def noise(doc_id, seed: int | str = SEED) -> int:
    """Thousandths of a Gumbel number that depends on seed and id alone, rounded down."""
    told = "null" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{told}".encode()).hexdigest()[:8], 16)
    return int(np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))))


def importance_scores(
    docs: DataFrame, gains: np.ndarray, id_column: str = "doc_id", text_column: str = "text", runs: int = LONGEST_RUN,
    seed: int | str = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def measured(text: pa.StringScalar) -> tuple[int, int, int]:
        words = features = weight = 0
        if text.is_valid:
            for n, found in bucket_pieces(text.as_buffer().to_pybytes(), runs, len(gains)):
                words, features, weight = words + n, features + len(found), weight + int(gains[found].sum())
        return words, features, weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                numbers = np.array([measured(t) for t in part.column("text")], np.int64).reshape(-1, 3)
                drawn = np.array([noise(i, seed) for i in part.column("doc_id").to_pylist()], np.int64)
                columns = [*numbers.T, numbers[:, 2] + drawn]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                    names=["doc_id", "n_words", "n_features", "weight", "score"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


ORDER = ["drop", "score", "doc_id", "row"]


def _sorted_runs(scored: DataFrame, least_words: int) -> DataFrame:
    """All rows, written as one sorted run a task; ``row`` holds the run and the place in it."""
    order = [F.col("drop"), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    runs = scored.withColumn("drop", F.col("n_words") < least_words).sortWithinPartitions(*order)
    return materialise(runs.withColumn("row", F.monotonically_increasing_id()), "runs")


def _key(score, doc_id, row) -> tuple:
    return -score, doc_id is None, doc_id if doc_id is not None else 0, row


def _with_segment(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Adds ``segment``: the number of splitters that a row does not come before."""
    edges = np.array([s[0] for s in splitters], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            down = -batch.column("score").to_numpy()
            segment = np.searchsorted(edges, down, side="right")
            # only where a splitter has the same score do id and row decide
            equal = np.flatnonzero(segment != np.searchsorted(edges, down, side="left"))
            part = batch.take(pa.array(equal))
            for at, key in zip(equal.tolist(), zip(*(part.column(c).to_pylist() for c in ORDER[1:]))):
                segment[at] = bisect_right(splitters, _key(*key))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment.astype(np.int32))], names=[*batch.schema.names, "segment"])

    return rows.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, segment int")


def ranked(scored: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the share of the rows long enough that is drawn, else null."""
    spark = scored.sparkSession
    runs = _sorted_runs(scored, least_words)
    able = runs.where(~F.col("drop"))
    size = able.agg(F.count("*").alias("n"), F.max(F.shiftright("row", 33)).alias("last")).first()
    wanted = share[0] * size["n"] // share[1]
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if wanted == 0:
        return runs.select(*columns, none)
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["n"] // segment_rows))
    gap = -(-size["n"] // min(parts * max(parts, size["last"] + 1), SAMPLES))
    samples = able.where(F.col("row").bitwiseAND((1 << 33) - 1) % gap == 0).select(*ORDER)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    # the samples are at most SAMPLES and one a run, however many rows there are
    placed = samples.withColumn("place", F.row_number().over(Window.partitionBy("drop").orderBy(*order)))
    step = max(1, -(-samples.count() // parts))
    splitters = sorted(_key(*r) for r in placed.where((F.col("place") > 1) & ((F.col("place") - 1) % step == 0)).select(*ORDER[1:]).collect())
    cut = _with_segment(able, splitters)
    counts = dict(map(tuple, cut.groupBy("segment").count().collect()))
    before = list(accumulate((counts.get(k, 0) for k in range(len(splitters) + 1)), initial=0))
    last = next(k for k in range(len(splitters) + 1) if before[k + 1] >= wanted)
    offsets = spark.createDataFrame([(k, before[k]) for k in range(last + 1)], "segment int, before long")
    inside = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    rank = F.col("before") + F.col("inside")
    merged = (
        cut.where(F.col("segment") <= last)
        .withColumn("inside", inside)
        .join(F.broadcast(offsets), "segment")
        .select(*columns, F.when(rank <= wanted, rank).alias("rank"))
    )
    behind = cut.where(F.col("segment") > last).select(*columns, none)
    return merged.unionByName(behind).unionByName(runs.where("drop").select(*columns, none))


def importance_ranks(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS,
    id_column: str = "doc_id", text_column: str = "text", target_text: str = "text", seed: int | str = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document, drawn to look like ``target``."""
    gains = bucket_gains(bucket_counts(target, target_text), bucket_counts(docs, text_column))
    return ranked(importance_scores(docs, gains, id_column, text_column, seed=seed), share, least_words)


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents drawn, all their columns kept. Rows that share an id come together; those without one are left."""
    drawn = importance_ranks(docs, target, id_column=id_column, **options).where("rank IS NOT NULL")
    return docs.join(drawn.select(F.col("doc_id").alias(id_column)).distinct(), id_column, "left_semi")


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    ranks = importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
WITH crc_table AS (
    SELECT list(c ORDER BY i) AS steps FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
        FROM range(256) r(i))
), texts AS (
    SELECT doc_id, text, true AS raw FROM documents UNION ALL SELECT NULL, text, false FROM benchmark
), numbered AS (
    SELECT row_number() OVER () AS line, doc_id, raw,
           list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM texts
), words AS (
    SELECT line, doc_id, raw, unnest(words) AS w, unnest(range(len(words))) AS spot FROM numbered
), ahead AS (
    SELECT line, raw, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY line ORDER BY spot)
), features AS (
    SELECT line, raw, w AS f FROM ahead
    UNION ALL SELECT line, raw, w || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL
    UNION ALL SELECT line, raw, w || ' ' || w2 || ' ' || w3 FROM ahead WHERE w3 IS NOT NULL
), counted AS (
    SELECT line, raw, f, count(*) AS n FROM features GROUP BY ALL
), hexed AS (
    SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)
), hashed AS (
    SELECT f, xor(list_reduce(
               list_transform(range(1, len(h), 2), lambda k: ('0x' || substr(h, k, 2))::BIGINT),
               lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM hexed, crc_table
), bucketed AS (
    SELECT line, raw, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (f) GROUP BY ALL
), buckets AS (
    SELECT bucket, coalesce(sum(n) FILTER (raw), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT raw), 0)::DOUBLE AS t
    FROM bucketed GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
    FROM buckets, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM buckets)
), weights AS (
    SELECT line, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM bucketed JOIN gains USING (bucket) WHERE raw GROUP BY line
), scored AS (
    SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM numbered LEFT JOIN weights USING (line) WHERE raw
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 5 * count(*) FILTER (n_words >= 20) OVER () // 100 THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
"""
