"""Jobs that gather texts, prompts and triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.fixed import CLUSTER_SEED, CLUSTERS, MAX_WORDS, PROMPTS_PER_TEXT
from quillwork.operators.clustering import Clusters, fit_clusters, fit_text_weights, text_embedder, with_cluster
from quillwork.operators.labeling import with_topic_label
from quillwork.operators.prompts import distinct_prompts, generated_prompts, with_prompt_metadata
from quillwork.operators.sampling import draw_prompts, prompt_pool, split_of
from quillwork.schemas import KEEP_TRIPLE, RAW_TEXTS, SPLITS, keep, require
from quillwork.session import materialise
from quillwork.sources.corpora import short_texts


def gather_texts(corpora: list[DataFrame], max_words: int = MAX_WORDS) -> DataFrame:
    """All corpora in one frame, short texts only."""
    union = require(corpora[0], RAW_TEXTS, "gather_texts")
    for corpus in corpora[1:]:
        union = union.unionByName(require(corpus, RAW_TEXTS, "gather_texts"))
    return short_texts(union, max_words)


def row_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows per corpus, split or version: the numbers a job logs."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"))


def build_prompts(
    triples: DataFrame, k: int = CLUSTERS, seed: int = CLUSTER_SEED, embed=None
) -> tuple[DataFrame, Clusters]:
    """Distinct prompts of the triples and the catalogue, with vectors and clusters; vectors are made once.

    ``embed(df, text_col, out_col)`` adds the vectors; unless given they are token counts weighted by how few prompts hold a token.
    """
    prompts = distinct_prompts(
        triples.select("source", "rewrite_prompt"), generated_prompts(triples.sparkSession)
    )
    embed = embed or text_embedder(fit_text_weights(prompts, "rewrite_prompt"))
    vectors = materialise(embed(prompts, "rewrite_prompt", "embeddings"), "vectors")
    model = fit_clusters(vectors, k=k, seed=seed, key=["source", "rewrite_prompt"])
    return with_cluster(vectors, model), model


def downloaded_texts(
    triples: DataFrame, prompts: DataFrame, key: list[str], logits: dict[str, Column], seed=42
) -> DataFrame:
    """Triples with a split, the metadata of their prompt and topic labels."""
    split = triples.withColumn("split", split_of(*key, seed=seed))
    joined = with_prompt_metadata(split, prompts, spread=key)
    kept = keep(joined, dict.fromkeys([*key, *KEEP_TRIPLE, "split", "prompt_source", "prompt_cluster"]))
    return with_topic_label(kept, logits)


def add_templates(
    texts: DataFrame, prompts: DataFrame, key: list[str], k: int = PROMPTS_PER_TEXT, seed=42,
    keep_drawn_source: bool = False,
) -> DataFrame:
    """``k`` balanced prompts per text, with prompt metadata, known splits only."""
    known = texts.where(F.col("split").isin(*SPLITS))
    return draw_prompts(known, prompt_pool(prompts, keep_drawn_source), key, k, seed)
