"""Benchmark decontamination by a distributed positional inverted index.

The corpus is indexed by shards of documents. A shard is one row of a written table: for each
term its sorted positions, and where its documents begin. A search takes test phrases in blocks of bounded size, goes
to every shard with them, starts from the postings of a phrase's rarest term there and
intersects them with the offset-adjusted postings of its other terms, rarest
first. With ``slop`` a term may stand that far from its place: a proximity match.
Shards need nothing of each other, so no term, however frequent, meets in one task.

Defined results: a null text has no words and no hits; a null item is matched but
not listed; items with equal ids are listed once; equal documents are rows of their
own; an empty benchmark leaves every document clean; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.common import slices, table
from quillwork.session import materialise

WINDOW = 10
#: Text bytes of a shard; a longer text is a shard of its own.
SHARD_BYTES = 2 << 20
#: Words of the test phrases that one search holds; a longer phrase is a block of its own.
BLOCK_WORDS = 1_000_000
#: Candidate places that a task looks at together.
AT_ONCE = 1 << 20
#: Lower-cases A-Z, makes every other ASCII byte that is no digit or small letter a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def phrase_blocks(items: DataFrame, id_column: str, text_column: str, block_words: int = BLOCK_WORDS):
    """Blocks of (ids, lists of words); items come one after another, so the driver holds a block at most."""
    ids, lists, held = [], [], 0
    for row in items.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")).toLocalIterator():
        words = words_of((row["text"] or "").encode())
        if words and held and held + len(words) > block_words:
            yield ids, lists
            ids, lists, held = [], [], 0
        if words:
            ids.append(row["id"])
            lists.append(words)
            held += len(words)
    yield ids, lists


class Phrases:
    """A block of phrases as numbers: each distinct window once, with the items that hold it."""

    def __init__(self, ids: list[str | None], lists: list[list[bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, words in zip(ids, lists):
            terms = [number.setdefault(w, len(number)) for w in words]
            for k in range(max(1, len(terms) - window + 1)):
                windows.setdefault(tuple(terms[k : k + window]), set()).add(item)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.terms = np.full((len(windows), window), -1, np.int64)
        for k, w in enumerate(windows):
            self.terms[k, : len(w)] = w
        self.items = [sorted(i for i in found if i is not None) for found in windows.values()]


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The postings of the vocabulary's terms, one row per shard of documents."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                sizes, found = [], []
                for text in part.column("text"):
                    words = words_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                    sizes.append(len(words))
                    found.append(np.fromiter(map(number, words, repeat(-1)), np.int32, count=len(words)))
                terms = np.concatenate(found)
                places = np.flatnonzero(terms >= 0)
                places = places[np.argsort(terms[places], kind="stable")].astype(np.int32)
                listed, counts = np.unique(terms[places], return_counts=True)
                blob = [pa.array([v.astype(np.int32).tobytes()], pa.binary()) for v in (listed, counts, places)]
                ids = part.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids])),
                        pa.array([sizes], pa.list_(pa.int32())),
                        *blob,
                    ],
                    names=["doc_ids", "n_words", "terms", "counts", "positions"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_ids array<{kind}>, n_words array<int>, terms binary, counts binary, positions binary"
    return materialise(rows.mapInArrow(run, schema), "index")


def shard_matches(
    terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, sizes: np.ndarray, phrases: Phrases, slop: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place of its first word) of every match in one shard."""
    postings = np.repeat(terms.astype(np.int64), counts) << 32 | positions  # sorted by term, then position
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    n_terms = len(phrases.vocabulary)
    length = np.zeros(n_terms + 1, np.int64)
    first = np.zeros(n_terms + 1, np.int64)
    length[terms], first[terms] = counts, np.cumsum(counts) - counts
    used = phrases.terms >= 0
    lists = np.where(used, length[phrases.terms], np.iinfo(np.int64).max)
    alive = np.flatnonzero((lists > 0).all(axis=1))
    order = np.argsort(lists[alive], axis=1, kind="stable")  # the rarest term of a phrase first
    rarest = lists[alive, order[:, 0]]
    ends = np.cumsum(rarest)
    found_phrase, found_place = [], []
    begin = 0
    while begin < len(alive):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + AT_ONCE, side="right")))
        who = np.repeat(np.arange(begin, end), rarest[begin:end])
        offset = order[who, 0]
        within = np.arange(len(who)) - np.repeat(ends[begin:end] - rarest[begin:end] - done, rarest[begin:end])
        start = positions[first[phrases.terms[alive[who], offset]] + within] - offset
        document = np.searchsorted(begins, start + offset, side="right") - 1
        low, high = begins[document], begins[document + 1]
        fits = (start >= low) & (start + phrases.lengths[alive[who]] <= high)
        who, start, low, high = who[fits], start[fits], low[fits], high[fits]
        for rank in range(1, phrases.terms.shape[1]):
            place = order[who, rank]
            term = phrases.terms[alive[who], place]
            left = term << 32 | np.maximum(start + place - slop, low)
            right = term << 32 | np.minimum(start + place + slop, high - 1)
            at = np.searchsorted(postings, left)
            there = (term < 0) | (at < len(postings)) & (postings[np.minimum(at, len(postings) - 1)] <= right)
            who, start, low, high = who[there], start[there], low[there], high[there]
        found_phrase.append(alive[who])
        found_place.append(start)
        begin = end
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_phrase]), np.concatenate([none, *found_place])


def search(index: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, hits, items): one row per indexed document.

    hits are the word ranges that matches cover, merged, as structs (s, e); items
    are the ids of the items with a match, sorted as strings.
    """
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast(phrases)
    spans = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                terms, counts, positions = (np.frombuffer(row.column(c)[0].as_buffer(), np.int32) for c in ("terms", "counts", "positions"))
                ids, sizes = row.column("doc_ids")[0].values, row.column("n_words")[0].values.to_numpy(zero_copy_only=False)
                phrase, start = shard_matches(terms, counts, positions, sizes, block, slop)
                begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                document = np.searchsorted(begins, start, side="right") - 1
                hits: list[list] = [[] for _ in sizes]
                items: list[list] = [[] for _ in sizes]
                by = np.lexsort((start, document))
                for d, p, s in zip(document[by].tolist(), phrase[by].tolist(), (start - begins[document])[by].tolist()):
                    e = s + int(block.lengths[p])
                    if hits[d] and s <= hits[d][-1]["e"]:
                        hits[d][-1]["e"] = max(e, hits[d][-1]["e"])
                    else:
                        hits[d].append({"s": s, "e": e})
                for d, p in set(zip(document.tolist(), phrase.tolist())):
                    items[d].extend(block.items[p])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(sizes, pa.int64()),
                        pa.array(hits, spans),
                        pa.array([sorted(set(i)) for i in items], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "n_words", "hits", "items"],
                )

    schema = f"doc_id {kind}, n_words long, hits array<struct<s:int,e:int>>, items array<string>"
    return index.mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    slop: int = 0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items): one row per document; n_hit words lie inside a match, items have one."""
    # equal ids with equal texts have equal results, so this pair is key enough where blocks have to meet
    key = F.struct(F.col(id_column).alias("id"), F.md5(F.col(text_column)).alias("digest"))
    keyed = docs.select(key.alias("doc_id"), F.col(text_column).alias("text"))
    found, blocks = None, 0
    for ids, lists in phrase_blocks(items, item_id_column, item_text_column, block_words):
        phrases = Phrases(ids, lists, window)
        part = search(build_index(keyed, phrases.vocabulary), phrases, slop)
        found, blocks = part if found is None else found.unionByName(part), blocks + 1
    if blocks > 1:
        found = (
            found.groupBy("doc_id", "n_words")
            .agg(F.flatten(F.collect_set("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                 (F.count("*") / blocks).cast("int").alias("rows"))
            .withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        )
    covered = F.aggregate(
        F.array_sort("hits"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["e"], x["s"]))).alias("n"), F.greatest(a["e"], x["e"]).alias("e")
        ),
        lambda a: a["n"].cast("long"),
    )
    return found.select("doc_id.id", "doc_id.digest", "n_words", covered.alias("n_hit"), "items").withColumnRenamed("id", "doc_id")


def phrase_matches(
    docs: DataFrame, phrases: DataFrame, slop: int = 0, window: int = WINDOW, id_column: str = "doc_id", item_id_column: str = "item_id"
) -> DataFrame:
    """(doc_id, start, words, items): the merged word ranges of phrase (slop 0) or proximity matches, by document."""
    parts = []
    for ids, lists in phrase_blocks(phrases, item_id_column, "text"):
        block = Phrases(ids, lists, window)
        parts.append(search(build_index(docs, block.vocabulary, id_column), block, slop).where(F.size("hits") > 0))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    ranges = found.select("doc_id", "items", F.explode("hits").alias("hit"))
    return ranges.select("doc_id", F.col("hit.s").alias("start"), (F.col("hit.e") - F.col("hit.s")).alias("words"), "items")


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents with no match. A text alone decides, so rows meet their result by its digest."""
    hit = contamination(docs.select("doc_id", "text"), items, **options).where("n_hit > 0").select(F.col("digest").alias("_digest")).distinct()
    return docs.join(materialise(hit, "contaminated"), F.md5("text") == F.col("_digest"), "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
