"""The given tables, seen as the inputs of the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.functions.text import word_count
from quillwork.operators.labeling import LanguageModel, train_language_model
from quillwork.operators.prompts import distinct_prompts, generated_prompts
from quillwork.operators.sampling import draw_prompts, prompt_pool, split_of
from quillwork.session import widen
from quillwork.sources.corpora import raw_texts

PAIR_KEY = ["conv_id", "turn"]


# declared, so that no job has to open files to learn a schema
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def texts(
    spark: SparkSession, sf_dir: str, heavy: bool = False, row_key=("doc_id",), max_words: int | None = None
) -> DataFrame:
    """``documents`` as raw_texts, keyed by doc_id; spread out first for ``heavy`` work per row."""
    documents = table(spark, sf_dir, "documents")
    if heavy:
        documents = widen(documents, "doc_id")
    return raw_texts(
        documents, "text", F.col("source"), split_of("doc_id"), F.lit("documents"), row_key=row_key, max_words=max_words
    )


def benchmark_prompts(spark: SparkSession, sf_dir: str, source: str = "benchmark") -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.lit(source).alias("source"), F.col("text").alias("rewrite_prompt"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated catalogue and the benchmark texts as a further source."""
    return distinct_prompts(generated_prompts(spark), benchmark_prompts(spark, sf_dir))


def shared_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of which every benchmark text is held by two sources."""
    return distinct_prompts(prompts(spark, sf_dir), benchmark_prompts(spark, sf_dir, "benchmark_again")).withColumn(
        "cluster", F.length("rewrite_prompt") % 10
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn that follows it.

    Turns of a conversation are numbered without gaps, so the next turn is an
    equi-join on (conv_id, turn): a huge conversation is spread over all tasks,
    which a window over conv_id would not do.
    """
    turns = table(spark, sf_dir, "conversations")
    user = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("original_text"))
    reply = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("rewritten_text")
    )
    return user.join(reply, PAIR_KEY)


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn pairs, each with one prompt drawn for it."""
    pool = prompt_pool(prompts(spark, sf_dir), keep_drawn_source=True)
    drawn = draw_prompts(turn_pairs(spark, sf_dir), pool, PAIR_KEY, k=1, seed=7)
    return drawn.select(
        *PAIR_KEY, "original_text", "rewritten_text", "rewrite_prompt", F.lit("conversations").alias("source")
    )


def split_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).withColumn("split", split_of(*PAIR_KEY))


def polluted_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split triples in which every other conversation repeats its prompt in the first line."""
    first_line = F.concat("rewrite_prompt", F.lit("\n"), "rewritten_text")
    return split_triples(spark, sf_dir).withColumn(
        "rewritten_text", F.when(F.col("conv_id") % 2 == 0, first_line).otherwise(F.col("rewritten_text"))
    )


def _marks(text: str, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(mark), F.lit("")))


def with_text_features(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """A text vector that SQL can express: length, words, commas, dots and one."""
    features = [F.length(text_col), word_count(text_col), _marks(text_col, ","), _marks(text_col, "."), F.lit(1)]
    return df.withColumn(out_col, F.array(*[f.cast("double") for f in features]))


def topic_logits(text: str, words: Column | None = None) -> dict[str, Column]:
    """A scorer made of columns: punctuation and length features as logits."""
    words = word_count(text) if words is None else words
    return {
        "marketing": _marks(text, ",") * F.lit(4.0) / words,
        "tweet": F.lit(20.0) / words,
        "news": _marks(text, ".") * F.lit(5.0) / words,
        "story": words / F.lit(200.0),
    }


# common words of the four languages of ``documents``
COMMON_WORDS = {
    "en": ["the", "and", "of", "to", "that", "is", "with", "was", "for"],
    "de": ["der", "die", "und", "das", "den", "von", "ist", "nicht"],
    "fr": ["le", "les", "et", "du", "dans", "est", "pour", "qui"],
    "es": ["el", "los", "y", "que", "las", "por", "con", "del"],
}


def english_share(text_col: str) -> Column:
    """A language scorer made of columns: the share of English among common words, 0 without any."""

    def hits(words: list[str]) -> Column:
        return F.size(F.filter(F.split(F.lower(text_col), " ", -1), lambda w: w.isin(*words)))

    every = [w for words in COMMON_WORDS.values() for w in words]
    return F.coalesce(F.try_divide(hits(COMMON_WORDS["en"]), hits(every)), F.lit(0.0))


def language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """The language model of the documents of the train split."""
    documents = texts(spark, sf_dir, heavy=True, row_key=("doc_id", "lang"))
    return train_language_model(documents.where(F.col("split") == "train"))


def vector_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` in groups of five: place 0 is the target, 1 to 4 the candidates."""
    return table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id div 5").alias("row_id"),
        (F.col("vec_id") % 5).cast("int").alias("place"),
        "vec_id", "embedding", "label",
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per group: target vector and text, candidate vectors and texts in order.

    Texts are made of the vectors' own rows, so every group with a target is there, also one without candidates.
    """

    def told(word: str) -> Column:
        return F.concat(F.lit(f"{word} "), "vec_id", F.lit(" of label "), "label")

    is_target = F.col("place") == 0
    listed = vector_groups(spark, sf_dir).groupBy("row_id").agg(
        F.array_sort(
            F.collect_list(F.when(~is_target, F.struct("place", told("Answer").alias("text"), "embedding")))
        ).alias("_members"),
        F.max(
            F.when(is_target, F.struct(told("Text").alias("text"), told("Rewritten").alias("rewritten"), "label", "embedding"))
        ).alias("_target"),
    )
    return listed.where(F.col("_target").isNotNull()).select(
        "row_id",
        split_of("row_id").alias("split"),
        F.concat(F.lit("v-"), F.col("_target.label") % 2 + 1).alias("version"),
        F.col("_target.text").alias("original_text"),
        F.col("_target.rewritten").alias("rewritten_text"),
        F.concat(F.lit("Rewrite like group "), F.col("_target.label")).alias("rewrite_prompt"),
        F.concat(F.lit("group-"), F.col("_target.label")).alias("source"),
        F.transform("_members", lambda m: m["text"]).alias("predicted"),
        F.transform("_members", lambda m: m["embedding"]).alias("predicted_vectors"),
        F.col("_target.embedding").alias("prompt_vector"),
    )
