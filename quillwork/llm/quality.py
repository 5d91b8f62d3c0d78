"""A quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, so counts stay dense in every language, and there is one
for each language and one for all together. Trusted documents are cut into n-grams and counted where they lie,
counts are summed by n-gram, and joins by context give each order's discounted shares and
the weight that passes to the order below. Discounts come from the counts of counts; lower orders
count how many characters precede.

Scoring is by joins too. Documents are written in chunks of bounded size, bucketed by chunk, and each chunk asks for its distinct n-grams.
All distinct n-grams asked for meet the shares and contexts of one order after the other, which gives
their probabilities; a last join answers the chunks, and a document's perplexity is summed in its chunk. Nothing passes
through the driver. The n-grams of the order joins are distinct and differ, within a key, in one symbol at most, so no key has
more than 65,536 rows; a key of the last join has one row for each chunk, a small part of what each chunk asks for. So no key
is hot in any of them, whatever a language's or source's share of the rows.

A document is kept if its perplexity is at most its language's quantile of trusted documents
which the model has not counted, found from counts of finely rounded values.

Defined results: a null or blank text has no perplexity and is not kept; a language that is null or
has few trusted documents is judged by all languages together; without trusted text every other document
is kept, with no perplexity; equal texts of a language have equal results; ids may be null or repeated; an empty table gives
no rows; other columns are not read, whatever their names; a very long text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from pyspark.sql.window import Window

from quillwork.llm.common import slices, table
from quillwork.operators.joins import lookup_join
from quillwork.session import materialise, new_folder

ORDER = 4
QUANTILE = 0.98
#: Languages with fewer trusted documents are judged by all languages together.
LEAST_DOCS = 50
ALL = "*"
SLICE = 2 << 20
#: Text bytes of a chunk of documents, which ask for n-grams together.
CHUNK_BYTES = 32 << 20
#: Logarithms of perplexity are compared in steps of this.
STEP = 0.001
#: Symbols are code points below this; others share the last.
SYMBOLS = 1 << 16


def grams(text: str) -> np.ndarray:
    """The text's n-grams, each of four 16-bit symbols in one number, the next character lowest.

    White space runs count as one space; 2 stands before the text and 3 after it.
    """
    code = np.frombuffer(" ".join(text.split()).encode("utf-32-le", "surrogatepass"), np.uint32)
    padded = np.concatenate([np.full(ORDER - 1, 2, np.uint64), np.minimum(code, SYMBOLS - 1).astype(np.uint64), [np.uint64(3)]])
    out = padded[: len(code) + 1].copy()
    for k in range(1, ORDER):
        out = out << np.uint64(16) | padded[k : k + len(out)]
    return out


def cut_to(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit((1 << (16 * order)) - 1))


def context_of(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def count_grams(trusted: DataFrame) -> DataFrame:
    """(lang, gram, n) over (lang, text), for each language and for all together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                by: dict[str, list] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text")):
                    by.setdefault(lang, []).append(grams(text.as_py()))
                for lang, found in by.items():
                    gram, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    each = materialise(trusted.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    return each.where(F.col("lang").isNotNull()).unionByName(each.groupBy("gram").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(ALL)))


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): modified discounts from how many n-grams were seen one to four times."""
    n = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    ratio = [F.coalesce(F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(0.5)) for k in (1, 2, 3)]
    cut = [F.greatest(F.lit(0.1), F.least(F.lit(k - 0.05), k - (k + 1) * y * r)) for k, r in zip((1, 2, 3), ratio)]
    return counts.groupBy("lang").agg(*n).select("lang", *[c.alias(f"d{k}") for k, c in zip((1, 2, 3), cut)])


def kneser_ney(trusted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """By order: (lang, gram, share) of seen n-grams, and (lang, context, back), what a context passes to the order below.

    Each is a written table of its own, so Spark knows their sizes before it joins them.
    """
    counts = {ORDER: materialise(count_grams(trusted), "counts")}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = materialise(counts[k + 1].groupBy("lang", cut_to(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n")), "counts")
    model = []
    for k in range(1, ORDER + 1):
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        # one row of discounts per language: small, and Spark broadcasts it by its measured size
        rows = counts[k].join(materialise(discounts(counts[k]), "discounts"), "lang").select("lang", "gram", "n", cut.alias("cut"), context_of(F.col("gram")).alias("context"))
        sums = materialise(rows.groupBy("lang", "context").agg(F.sum("n").alias("whole"), F.sum("cut").alias("taken")), "sums")
        shares = rows.join(sums, ["lang", "context"]).select("lang", "gram", ((F.col("n") - F.col("cut")) / F.col("whole")).alias("share"))
        model.append((materialise(shares, "shares"), sums.select("lang", "context", (F.col("taken") / F.col("whole")).alias("back"))))
    return model


@contextmanager
def in_chunks(docs: DataFrame, chunk_bytes: int) -> Iterator[DataFrame]:
    """``docs``, written with the number of the chunk they fall into: runs of rows of at most ``chunk_bytes``, or one row.

    The written numbers are read by both passes, so a task that is run again cannot number otherwise. The table is
    bucketed by chunk, so texts do not move when answers come to them; its name, not its files, goes at the end.
    """
    spark, names = docs.sparkSession, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in slices(batch, "text", min(chunk_bytes, SLICE)):
                size = part.column("text").nbytes
                if filled and filled + size > chunk_bytes:
                    number, filled = number + 1, 0
                filled += size
                yield pa.RecordBatch.from_arrays([pa.array([number] * part.num_rows, pa.int64()), *part.columns], names=["chunk", *names])

    schema = StructType([StructField("chunk", LongType()), *docs.schema.fields])
    path = new_folder(spark, "chunks")
    name = "quillwork_" + path.rsplit("-", 1)[1]
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    docs.mapInArrow(run, schema).write.bucketBy(buckets, "chunk").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def asked(chunks: DataFrame) -> DataFrame:
    """(chunk, lang, gram): the distinct n-grams of each chunk; a chunk that two tasks read may ask twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang, gram in seen.items():
                of = [pa.array([now] * len(gram), pa.int64()), pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64))]
                yield pa.RecordBatch.from_arrays(of, names=["chunk", "lang", "gram"])

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found: dict[tuple[int, str], list] = {}
                for chunk, lang, text in zip(*(part.column(c).to_pylist() for c in ("chunk", "model_lang", "text"))):
                    if text and text.strip():
                        found.setdefault((chunk, lang), []).append(grams(text))
                for (chunk, lang), some in found.items():
                    if chunk != now:
                        yield from told()
                        now, seen = chunk, {}
                    seen[lang] = np.unique(np.concatenate([seen.get(lang, np.zeros(0, np.uint64)), *some]))
        yield from told()

    return materialise(chunks.select("chunk", "model_lang", "text").mapInArrow(run, "chunk long, lang string, gram long"), "asked")


def gram_scores(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, p) for distinct (lang, gram): shares of each order, and what its context passes to the order below."""
    scores = None
    for k in range(1, ORDER + 1):
        rows = wanted.select("lang", cut_to(F.col("gram"), k).alias("gram")).distinct() if k < ORDER else wanted
        shares, backs = model[k - 1]
        rows = rows.withColumn("context", context_of(F.col("gram"))).join(shares, ["lang", "gram"], "left").join(backs, ["lang", "context"], "left")
        below = F.lit(1.0 / SYMBOLS)
        if scores is not None:
            lower = scores.select("lang", F.col("gram").alias("lower"), F.col("p").alias("below"))
            rows, below = rows.withColumn("lower", cut_to(F.col("gram"), k - 1)).join(lower, ["lang", "lower"]), F.col("below")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * below
        scores = materialise(rows.select("lang", "gram", p.alias("p")), "scores")
    return scores


def perplexities(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of (doc_id, lang, model_lang, text) without text, and their perplexity, null for blank texts."""
    key = ["doc_id", "lang", "model_lang"]

    def run(rows: pa.Table, answer: pa.Table) -> pa.Table:
        known, out = {}, []
        for lang, text in zip(rows.column("model_lang").to_pylist(), rows.column("text")):
            if not text.is_valid or not text.as_py().strip():
                out.append(None)
                continue
            if lang not in known:
                own = answer.filter(pc.equal(answer.column("lang"), lang))
                gram, log_p = own.column("gram").to_numpy().view(np.uint64), own.column("log_p").to_numpy()
                order = np.argsort(gram, kind="stable")
                known[lang] = gram[order], log_p[order]
            gram, log_p = known[lang]
            found = log_p[np.searchsorted(gram, grams(text.as_py()))]
            out.append(float(np.exp(-found.mean())))
        return rows.select(key).append_column("perplexity", pa.array(out, pa.float64()))

    with in_chunks(docs.select(*key, "text"), chunk_bytes) as chunks:
        requests = asked(chunks)
        scores = gram_scores(materialise(requests.select("lang", "gram").distinct(), "wanted"), model)
        answers = requests.join(scores, ["lang", "gram"]).select("chunk", "lang", "gram", F.log("p").alias("log_p"))
        schema = StructType([*(docs.schema[k] for k in key), StructField("perplexity", DoubleType())])
        return materialise(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema), "perplexities")


def quantiles(values: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(model_lang, threshold): the quantile of (model_lang, perplexity), rounded up to a step.

    Values are counted by step before they meet, and logarithms of perplexity span at most some 50,000 steps.
    """
    counts = values.groupBy("model_lang", F.ceil(F.log("perplexity") / STEP).alias("bin")).count()
    by = Window.partitionBy("model_lang").orderBy("bin")
    whole = Window.partitionBy("model_lang")
    reached = counts.withColumn("below", F.sum("count").over(by)).withColumn("whole", F.sum("count").over(whole))
    return reached.where(F.col("below") >= quantile * F.col("whole")).groupBy("model_lang").agg(F.exp(F.min("bin") * STEP).alias("threshold"))


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) for each row of (doc_id, text, lang).

    ``trusted_ids`` (one column) names trusted documents; three of sixteen of them, by a hash, set the thresholds and
    the others the counts.
    """
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    ids = materialise(ids.withColumn("_held", F.substring(F.md5(F.concat(F.lit("quality|"), F.col("doc_id").cast("string"))), 1, 1).isin(*"012")), "trusted")
    rows = docs.select("doc_id", "text", "lang")
    # texts move only if the ids are too many to be sent, and then each once
    teach = lookup_join(rows.where("trim(text) != ''"), ids.where("NOT _held").select("doc_id"), ["doc_id"], spread=["text"]).select("lang", "text")
    few = materialise(teach.groupBy("lang").count(), "languages")
    own = few.where((F.col("count") >= LEAST_DOCS) & F.col("lang").isNotNull()).select(F.col("lang").alias("_lang"))
    named = rows.join(own, F.col("lang") == F.col("_lang"), "left").select("doc_id", "lang", F.coalesce("_lang", F.lit(ALL)).alias("model_lang"), "text")
    if few.limit(1).count() == 0:
        blank = F.coalesce(F.trim("text"), F.lit("")) == ""
        return named.select("doc_id", "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), (~blank).alias("keep"))
    scored = perplexities(named, kneser_ney(teach), chunk_bytes)
    known = scored.where("perplexity IS NOT NULL").join(ids.where("_held").select("doc_id"), "doc_id")
    # every language is also among all together; a language without held-out documents takes that threshold
    every = known.select("model_lang", "perplexity").unionByName(known.select(F.lit(ALL).alias("model_lang"), "perplexity"))
    limits = materialise(quantiles(every, quantile).withColumnRenamed("model_lang", "_m"), "thresholds")
    for_all = limits.where(F.col("_m") == ALL).agg(F.max("threshold")).first()[0]
    threshold = F.coalesce("threshold", F.lit(float("inf") if for_all is None else for_all))
    return scored.join(limits, F.col("model_lang") == F.col("_m"), "left").select(
        "doc_id", "lang", "perplexity", threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("keep")
    )


def op2_quality(spark, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return classify(table(spark, sf_dir, "documents"), trusted)
