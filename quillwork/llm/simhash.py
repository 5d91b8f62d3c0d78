"""SimHash near duplicates by tiled exact comparison.

A fingerprint has a bit set where more than half of a text's shingle hashes have
it. Distinct fingerprints are put into tiles by the population counts of their
four 16-bit quarters. Each differing bit changes one of these counts by one, so two fingerprints
within the radius lie in tiles whose counts differ by at most the radius in sum;
all other tile pairs are skipped, and those left are compared whole with numpy
exclusive-or and bit counts.

Defined results: a null or blank text has fingerprint zero, linked like any other;
a null doc_id is the smallest of its component only where it has no other; repeated
rows share a fingerprint; an empty table gives an empty table. No text, tile or
group is cut: crowded tiles are dealt over more blocks, and exact copies are one fingerprint.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillwork.llm.common import LOWER, SLICE_BYTES, slices, table
from quillwork.llm.components import connected_components
from quillwork.session import materialise

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a block; a tile with more is dealt over several blocks.
BLOCK = 4096
QUARTERS = 4
#: Shingles whose bits are counted at once: 64 bytes each.
COUNTED = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of UTF-8 text, as an unsigned number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = max(1, len(words) - width + 1)
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a : b - 1], seed) for a, b in zip(starts[:last], ends[width - 1 :])), np.dtype("<u8"), count=last
    )
    ones = np.zeros(64, np.int64)
    for begin in range(0, last, COUNTED):
        part = hashes[begin : begin + COUNTED]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > last, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, keep: list[str], text_column: str = "text", width: int = SHINGLE_WORDS, name: str = "fp") -> DataFrame:
    """The columns ``keep`` of every row and ``name``, the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column, SLICE_BYTES):
                found = [fingerprint(t.as_buffer().to_pybytes(), width) if t.is_valid else 0 for t in part.column(text_column)]
                columns = [part.column(k) for k in keep] + [pa.array(np.array(found, np.uint64).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, name])

    rows = docs.select(*dict.fromkeys([*keep, text_column]))
    return rows.mapInArrow(run, StructType([*(docs.schema[k] for k in keep), StructField(name, LongType())]))


def _within(radius: int, dims: int = QUARTERS) -> list[tuple[int, ...]]:
    """Steps between tiles to compare: zero, and one of each pair of opposite steps of size up to ``radius``."""
    steps = itertools.product(range(-radius, radius + 1), repeat=dims)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * dims]


def _tile(counts) -> F.Column:
    """One number for the counts of the quarters; each is 0 to 16, so steps beyond give no tile's number."""
    number = F.lit(0)
    for c in counts:
        number = number * 64 + c
    return number


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects what is linked between two blocks: one row per node but the smallest of its set.

    Links within a crowd are as many as its size squared; a forest has the same components.
    """
    shift = 0 if same else len(a)
    label = np.arange(shift + len(b))
    for begin in range(0, len(a), 256):
        i, j = np.nonzero(np.bitwise_count(a[begin : begin + 256, None] ^ b[None, :]) <= radius)
        # only links between sets that are still apart, each pair of sets once
        x, y = label[i + begin], label[j + shift]
        apart = np.unique((np.minimum(x, y) * len(label) + np.maximum(x, y))[x != y])
        while len(apart):
            low, high = apart // len(label), apart % len(label)
            root = np.arange(len(label))
            np.minimum.at(root, high, low)
            while not np.array_equal(root, root[root]):
                root = root[root]
            label = root[label]
            x, y = root[low], root[high]
            apart = np.unique((np.minimum(x, y) * len(label) + np.maximum(x, y))[x != y])
    nodes = (a if same else np.concatenate([a, b])).view(np.int64)
    low = np.full(len(label), np.iinfo(np.int64).max)
    np.minimum.at(low, label, nodes)
    rest = np.flatnonzero(low[label] != nodes)
    return nodes[rest], low[label[rest]]


def near_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links with the same components as all pairs of fingerprints at ``radius`` or fewer bits."""
    quarters = [
        F.bit_count(F.shiftrightunsigned(F.col("fp"), 16 * q).bitwiseAND(F.lit(0xFFFF))).cast("long") for q in range(QUARTERS)
    ]
    # 8 is added so that steps below zero stay apart from other tiles
    tiled = distinct.select("fp", _tile([q + 8 for q in quarters]).alias("tile"))
    sizes = tiled.groupBy("tile").count().select("tile", F.ceil(F.col("count") / block).alias("blocks"))
    blocks = materialise(
        tiled.join(sizes, "tile")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        .groupBy("tile", "block")
        .agg(F.collect_list("fp").alias("fps"), F.first("blocks").alias("blocks")),
        "tiles",
    )
    steps = F.array(*[F.lit(sum(x * 64 ** (QUARTERS - 1 - k) for k, x in enumerate(s))) for s in _within(radius)])
    asked = blocks.select("tile", "block", "fps", F.explode(steps).alias("step")).select(
        "block", "step", F.col("fps").alias("a"), (F.col("tile") + F.col("step")).alias("tile")
    )
    pairs = asked.join(blocks.select("tile", F.col("block").alias("other"), F.col("fps").alias("b")), "tile").where(
        (F.col("step") != 0) | (F.col("block") <= F.col("other"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(batch.column("a"), batch.column("b"), batch.column("same").to_pylist()):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (a, b))
                i, j = tile_links(x, y, radius, same)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j)], names=["a", "b"])

    same = (F.col("step") == 0) & (F.col("block") == F.col("other"))
    # arrays are small and their comparison is not, so the number of tasks must not follow the bytes
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(tasks, "tile", "step", "block", "other").select("a", "b", same.alias("same"))
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, fp, component, component_id): one row per document.

    component is the smallest fingerprint reachable, as a signed number, and
    component_id the smallest doc_id of the component.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    prints = materialise(with_fingerprint(rows, ["doc_id"], "text", width), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    labels = connected_components(near_links(distinct, radius)).withColumnRenamed("node", "fp")
    classes = distinct.join(labels, "fp", "left").select("fp", "low", F.coalesce("label", "fp").alias("component"))
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    return prints.join(classes.join(lowest, "component").select("fp", "component", "component_id"), "fp")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One document of each component: that with the smallest id, or any one where no row has an id.

    Of rows that share the smallest id, and of components without ids, the row that is smallest as
    JSON stays. Only rows whose id is not unique are fingerprinted again with all
    their columns, and these are combined before the shuffle. Columns are numbered meanwhile, so no name of
    the caller's can clash.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    key, text = names[docs.columns.index(id_column)], names[docs.columns.index(text_column)]
    known = materialise(near_duplicates(rows, key, text, **options), "near")
    ids = known.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
    kept = rows.join(ids.where("first"), F.col(key) == F.col("doc_id")).drop("doc_id", "first")
    unsure = kept.where("rows > 1").select(*names).unionByName(rows.where(F.col(key).isNull()))
    whole = F.struct(*names)
    chosen = F.min_by(whole, F.to_json(whole)).alias("row")
    groups = known.where("doc_id <=> component_id").select("fp", "component", "component_id").distinct()
    smallest = (
        with_fingerprint(unsure, names, text, options.get("width", SHINGLE_WORDS))
        .groupBy("fp", key).agg(chosen)
        .join(groups.withColumnRenamed("fp", "print"), (F.col("fp") == F.col("print")) & F.col(key).eqNullSafe(F.col("component_id")))
        .groupBy("component").agg(F.min_by("row", F.to_json("row")).alias("row"))
        .select("row.*")
    )
    return kept.where("rows = 1").select(*names).unionByName(smallest).toDF(*docs.columns)


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    known = near_duplicates(table(spark, sf_dir, "documents"))
    return known.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
