"""Jobs that score candidates and build training and evaluation sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.functions.text import after_last, strip
from quillwork.functions.vectors import cosine
from quillwork.operators.clustering import with_text_vector
from quillwork.operators.formatting import format_rows, formatted, style_of, with_marker
from quillwork.operators.generation import generate_candidates
from quillwork.operators.pairs import preference_pairs
from quillwork.operators.ranking import same_key, sample_per_split
from quillwork.operators.sampling import attach_examples
from quillwork.operators.scorers import BatchScorer, with_scores
from quillwork.operators.scoring import similarity_summary, with_candidate_scores
from quillwork.schemas import EXAMPLE, SCORED, require
from quillwork.session import materialise
from quillwork.sources.versions import VersionedTables

Embedder = Callable[[DataFrame, str, str], DataFrame]


def inference_inputs(
    df: DataFrame, style: str, key: list[str], examples=None, system: str = "none", open_answer: bool = False, seed=0
) -> DataFrame:
    """Formatted rows without an answer; original and rewritten text in their own places."""
    return format_rows(
        df, style, key, rewrite_prompt=None, examples=examples, system=system, open_answer=open_answer, seed=seed
    )


def embed_candidates(df: DataFrame, key: list[str], embed: Embedder = with_text_vector) -> DataFrame:
    """Adds ``predicted_vectors`` and ``prompt_vector``.

    Each candidate is embedded as its own row, so a long list is spread out, and
    the few vectors of a row come together again by key.
    """
    prompt = embed(df, "rewrite_prompt", "prompt_vector")
    flat = embed(df.select(*key, F.posexplode("predicted").alias("_at", "_text")), "_text", "_vector")
    lists = flat.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "_vector"))).alias("_list"))
    vectors = F.transform("_list", lambda e: e["_vector"])
    none = F.slice(F.array("prompt_vector"), 1, 0)  # a row without candidates stays, with no vectors
    met = prompt.join(lists.withColumnsRenamed({c: f"_of_{c}" for c in key}), same_key(key), "left")
    return met.select(*prompt.columns, F.coalesce(vectors, none).alias("predicted_vectors"))


def score_candidates(
    df: DataFrame,
    style: str,
    key: list[str],
    generator: BatchScorer,
    params: dict,
    embed: Embedder = with_text_vector,
    batch_size: int = 2,
    **options,
) -> DataFrame:
    """Format without answer, generate candidates, score them against the prompt."""
    inputs = inference_inputs(df, style, key, **options)
    generated = materialise(generate_candidates(inputs, generator, params, batch_size), "candidates")
    scored = with_candidate_scores(embed_candidates(generated, key, embed))
    return scored.drop("predicted_vectors", "prompt_vector")


def gather_pairs(tables: VersionedTables, key: list[str], kind: str = "generated_and_scored_texts") -> DataFrame:
    """Preference pairs of the newest revision of every version.

    ``key`` must tell the rows of one (version, split) apart.
    """
    return preference_pairs(require(tables.read_all(kind, SCORED), SCORED, "gather_pairs"), key)


def test_pool(df: DataFrame, key: list[str]) -> DataFrame:
    """The test split as a few-shot pool, written once since it is read several times."""
    pool = df.where(F.col("split") == "test").select(*key, *EXAMPLE.names)
    return materialise(pool, "pool")


def supervised_examples(
    df: DataFrame,
    style: str,
    key: list[str],
    num_examples: int = 1,
    system: str = "none",
    pool: DataFrame | None = None,
    seed=0,
) -> DataFrame:
    """Formatted ``input`` per split, for rows that hold the response marker.

    The few-shot pool is the test split unless another is given: so test rows show
    up in training inputs. Pass a pool to avoid that.
    """
    examples = None
    if style_of(style).layout == "stack":
        pool = test_pool(df, key) if pool is None else pool
        df = attach_examples(df, pool, key, key, num_examples, seed)
        examples = "examples"
    texts = format_rows(df, style, key, examples=examples, system=system, seed=seed)
    return with_marker(texts, style).select(*key, "split", "input")


def preference_examples(pairs: DataFrame, style: str, key: list[str], seed=0, **options) -> DataFrame:
    """``chosen``, ``rejected`` and ``prompt`` texts with one template draw per row."""

    def text(answer) -> Column:
        return formatted(style, key, rewrite_prompt=answer, seed=seed, **options)

    return pairs.select(
        *dict.fromkeys([*key, "split"]),
        text("chosen").alias("chosen"),
        text("rejected").alias("rejected"),
        text(None).alias("prompt"),
    )


def extract_response(text, style: str) -> Column:
    """The answer in a decoded generation: after the last marker, stripped."""
    return strip(after_last(text, style_of(style).answer_marker))


def evaluate(
    df: DataFrame,
    style: str,
    key: list[str],
    generator: BatchScorer,
    embed: Embedder = with_text_vector,
    validation_size: int | None = None,
    num_examples: int = 1,
    system: str = "none",
    pool: DataFrame | None = None,
    open_answer: bool = False,
    batch_size: int = 8,
    seed=0,
) -> DataFrame:
    """Mean similarity of generated and true prompts on the validation split.

    Answers and prompts stay on one row, so a row that lacks the marker takes its
    prompt with it. ``generator`` returns the whole decoded text per input.
    """
    rows = df.where(F.col("split") == "validation")
    if validation_size is not None:
        rows = rows.limit(0) if validation_size == 0 else sample_per_split(rows, validation_size, key, seed, ("validation",))
    examples = None
    if style_of(style).layout == "stack":
        pool = test_pool(df, key) if pool is None else pool
        rows = attach_examples(rows, pool, key, key, num_examples, seed)
        examples = "examples"
    inputs = with_marker(inference_inputs(rows, style, key, examples, system, open_answer, seed), style)
    decoded = with_scores(
        inputs, generator, {"input": "input"}, "struct<decoded: string>", batch_size, repeatable=False
    )
    answers = materialise(
        decoded.select(*key, "split", "rewrite_prompt", extract_response("decoded", style).alias("response")), "answers"
    )
    vectors = embed(embed(answers, "response", "_response"), "rewrite_prompt", "_prompt")
    return similarity_summary(vectors, cosine("_response", "_prompt"), ["split"])
