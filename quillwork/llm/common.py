"""What several operators share: the given tables, batches of bounded size, hold-out, spans of words."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task works on at once; longer texts are a slice of their own.
SLICE_BYTES = 4 << 20
#: Lower-cases A-Z and leaves every other byte, so UTF-8 text stays what it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows kept from learning: crc32(doc_id as text) mod 3 is 1. A null id is never held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes, or of one row."""
    if batch.num_rows == 0:
        return
    sizes = np.diff(np.frombuffer(_plain(batch.column(text)).buffers()[1], np.int32)[: batch.num_rows + 1].astype(np.int64))
    ends = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _plain(array: pa.Array) -> pa.Array:
    """The same strings with offsets that begin at the buffer's first entry."""
    return array if array.offset == 0 and array.type == pa.string() else pa.concat_arrays([array.cast(pa.string()), pa.array([], pa.string())])


def per_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES):
    """A mapInArrow function that gives ``work`` slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                yield work(part)

    return run


def below_share(rows: DataFrame, hash_column: str, most: int, count: int) -> DataFrame:
    """The rows whose hash (MD5 in hex) is among the smallest: about twice the ``most`` of ``count`` that are wanted."""
    if count <= 2 * most + 100:
        return rows
    share = F.conv(F.substring(hash_column, 1, 8), 16, 10).cast("bigint") / F.lit(float(16**8))
    return rows.where(share < (2.0 * most + 100) / count)


def first_by_hash(rows: DataFrame, hash_column: str, most: int, count: int) -> DataFrame:
    """The ``most`` rows of ``count`` with the smallest hashes; what is sorted for it does not grow with the table."""
    return below_share(rows, hash_column, most, count).orderBy(hash_column).limit(most)


def digest_uniform(seed: int | str, purpose: str, key: Column) -> Column:
    """Uniform double in [0, 1) that depends on purpose, seed and key alone."""
    digest = F.md5(F.concat(F.lit(f"{purpose}|{seed}|"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(16**13))
