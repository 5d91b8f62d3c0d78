"""Jobs from templates to rewritten, repaired and gathered texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from quillwork.fixed import (
    ALLOWED_LABELS,
    ENGLISH_THRESHOLD,
    POLLUTION_THRESHOLD,
    SAMPLE_PER_SPLIT,
    SKIP_PROBABILITY,
)
from quillwork.functions.text import token_containment
from quillwork.operators.generation import generate_texts, with_generation_input
from quillwork.operators.labeling import (
    allowed_topics,
    english_only,
    label_pollution,
    unpolluted,
    with_topic_label,
)
from quillwork.operators.ranking import sample_per_split
from quillwork.operators.sampling import requested_splits
from quillwork.operators.scorers import BatchScorer
from quillwork.schemas import GATHERED, require
from quillwork.session import materialise
from quillwork.sources.versions import VersionedTables


def select_texts(
    templates: DataFrame,
    key: list[str],
    with_english: Callable[[DataFrame], DataFrame],
    topic_logits: dict[str, Column],
    version: int,
    split: str = "train",
    num_samples: int = SAMPLE_PER_SPLIT,
    prob_en: float = ENGLISH_THRESHOLD,
    labels=ALLOWED_LABELS,
    seed=None,
) -> DataFrame:
    """Sample per split, keep English, keep allowed topics: cheap steps first.

    ``with_english`` adds the column ``en``. The seed is the version unless given,
    so each version samples other rows. The sample is written, as a filter on its scores would else be pushed
    below it and every text be scored.
    """
    seed = version if seed is None else seed
    sampled = materialise(sample_per_split(templates, num_samples, key, seed, requested_splits(split)), "sample")
    english = english_only(with_english(sampled), prob_en)
    return allowed_topics(with_topic_label(english, topic_logits), labels)


def rewrite_texts(
    selected: DataFrame, key: list[str], generator: BatchScorer, model: str, params: dict, seed=0,
    batch_size: int = 8, echoes: bool = False,
) -> DataFrame:
    """Render generation inputs, generate, drop failures; written once, as a model is not repeatable."""
    inputs = with_generation_input(selected, key, seed)
    return materialise(generate_texts(inputs, generator, model, params, batch_size, echoes), "rewritten")


def label_rewritten(
    df: DataFrame, key: list[str], scorer=token_containment, skip_prob: float = SKIP_PROBABILITY, seed=0
) -> DataFrame:
    """Score rewritten texts for pollution and repair those that can be."""
    return label_pollution(df, key, scorer, skip_prob, seed=seed)


def gather_rewritten(
    tables: VersionedTables, kind: str = "labeled_rewritten_texts", threshold: float = POLLUTION_THRESHOLD
) -> DataFrame:
    """Unpolluted texts of the newest revision of every version; the version is kept.

    The filter reaches the scan, so polluted texts are not read out of row groups
    that hold none to keep.
    """
    return unpolluted(require(tables.read_all(kind, GATHERED), GATHERED, "gather_rewritten"), threshold)
