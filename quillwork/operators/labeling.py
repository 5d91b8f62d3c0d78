"""Language, topic and pollution labels, and the filters and repair they drive."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.fixed import (
    ALLOWED_LABELS,
    ENGLISH_THRESHOLD,
    POLLUTION_THRESHOLD,
    REPAIR_THRESHOLD,
    SKIP_PROBABILITY,
)
from quillwork.functions.arrays import let
from quillwork.functions.text import drop_first_line, pollution_question, token_containment
from quillwork.operators.joins import Size, lookup_join
from quillwork.operators.sampling import bypassed
from quillwork.operators.scorers import BatchScorer, rescored_column
from quillwork.session import materialise

# -- language ---------------------------------------------------------------

TOKEN_BUCKETS = 1 << 16


@dataclass(frozen=True)
class LanguageModel:
    """Naive Bayes as a table: for each token bucket, ln(count + 1) in every language."""

    shares: DataFrame  # bucket, counts: array<double> in the order of ``languages``
    languages: tuple[str, ...]
    log_priors: tuple[float, ...]
    log_totals: tuple[float, ...]  # ln(tokens + buckets)
    buckets: int


def _token_buckets(df: DataFrame, column: str, text_col: str, buckets: int) -> DataFrame:
    """(column, _bucket): one row per token, its CRC-32 modulo ``buckets``, and one with bucket -1 for the text itself."""
    told = F.concat(F.split(F.lower(text_col), " ", -1), F.array(F.lit(None).cast("string")))
    bucket = F.coalesce((F.crc32(F.col("_token").cast("binary")) % buckets).cast("int"), F.lit(-1))
    return df.select(column, F.explode(told).alias("_token")).select(column, bucket.alias("_bucket"))


def train_language_model(
    df: DataFrame, text_col: str = "original_text", label_col: str = "lang", buckets: int = TOKEN_BUCKETS
) -> LanguageModel:
    """Naive Bayes over token counts of the whole text, smoothed by one.

    Fitting is one pass that counts tokens by bucket and language, combined before the shuffle. The counts stay a written
    table; three numbers a language reach the driver. Rows without text or label teach nothing.
    """
    known = df.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    labelled = _token_buckets(known.withColumn("_label", F.col(label_col).cast("string")), "_label", text_col, buckets)
    counts = materialise(labelled.groupBy("_label", "_bucket").agg(F.count("*").alias("_n")), "tokens")
    sizes = counts.groupBy("_label").agg(
        F.sum(F.when(F.col("_bucket") < 0, F.col("_n"))).alias("texts"),
        F.coalesce(F.sum(F.when(F.col("_bucket") >= 0, F.col("_n"))), F.lit(0)).alias("tokens"),
    ).orderBy("_label").collect()
    if not sizes:
        raise ValueError("no text has a language")
    languages = tuple(r["_label"] for r in sizes)
    held = F.map_from_entries(F.collect_list(F.struct("_label", "_n")))
    listed = F.transform(F.array(*map(F.lit, languages)), lambda name: F.ln(F.coalesce(F.try_element_at("_held", name), F.lit(0)) + F.lit(1.0)))
    shares = counts.where("_bucket >= 0").groupBy("_bucket").agg(held.alias("_held")).select("_bucket", listed.alias("_counts"))
    every = sum(r["texts"] for r in sizes)
    return LanguageModel(
        materialise(shares, "language_model"), languages, tuple(math.log(r["texts"] / every) for r in sizes),
        tuple(math.log(r["tokens"] + buckets) for r in sizes), buckets,
    )


def with_language_probability(
    df: DataFrame, model: LanguageModel, text_col: str = "original_text", language: str = "en", out_col: str = "en"
) -> DataFrame:
    """Adds P(language), null for a null text.

    Tokens meet the model's table, and their log shares are summed per text before the shuffle, so what is shuffled is a row a
    text. Equal texts are one group: their sums are divided by their number. The sums are written; the
    rows then meet them by the text's digest.
    """
    number = model.languages.index(language)
    rows = df.withColumn("_text", F.md5(text_col))
    tokens = _token_buckets(rows.where(F.col(text_col).isNotNull()), "_text", text_col, model.buckets)
    bound = Size(model.buckets, model.buckets * (8 * len(model.languages) + 64))
    met = lookup_join(tokens, model.shares, ["_bucket"], spread=["_text"], how="left", size=bound)
    sums = met.groupBy("_text").agg(
        F.count_if(F.col("_bucket") >= 0).alias("_n"), F.count_if(F.col("_bucket") < 0).alias("_rows"),
        *[F.coalesce(F.sum(F.get("_counts", F.lit(i))), F.lit(0.0)).alias(f"_of_{i}") for i in range(len(model.languages))],
    )
    scores = [
        F.lit(prior) + (F.col(f"_of_{i}") - F.col("_n") * F.lit(total)) / F.col("_rows")
        for i, (prior, total) in enumerate(zip(model.log_priors, model.log_totals))
    ]
    shares = [F.exp(F.least(s - F.col("_own"), F.lit(700.0))) for s in scores]
    told = materialise(sums.withColumn("_own", scores[number]).select("_text", (F.lit(1.0) / sum(shares[1:], shares[0])).alias("_p")), "language")
    kept = [c for c in df.columns if c != out_col]
    spread = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType) and f.name != text_col] or ["_text"]
    return lookup_join(rows, told, ["_text"], spread=spread, how="left").select(*kept, F.col("_p").alias(out_col))


def english_only(df: DataFrame, threshold: float = ENGLISH_THRESHOLD) -> DataFrame:
    return df.where(F.col("en") > F.lit(threshold))


# -- topic ------------------------------------------------------------------


def softmax(logits: Column, names: list[str]) -> Column:
    """Struct of logits to struct of probabilities, shifted by the largest logit."""

    def shifted(z):
        top = F.greatest(*[z[name] for name in names])
        return F.struct(*[F.exp(z[name] - top).alias(name) for name in names])

    def shares(e):
        total = sum((e[name] for name in names[1:]), e[names[0]])
        return F.struct(*[(e[name] / total).alias(name) for name in names])

    return let(let(logits, shifted), shares)


def most_likely(scores: Column, names: list[str]) -> Column:
    """Name of the first largest field of a struct of scores."""
    best = F.greatest(*[scores[name] for name in names])
    label = F.lit(names[-1])
    for name in reversed(names[:-1]):
        label = F.when(scores[name] == best, F.lit(name)).otherwise(label)
    return label


def with_topic_label(df: DataFrame, logits: dict[str, Column]) -> DataFrame:
    """Adds one probability per label and ``most_likely_label`` (first one on a tie)."""
    names = list(logits)
    if len(names) < 2:
        raise ValueError("give at least two labels")
    given = F.struct(*[z.cast("double").alias(name) for name, z in logits.items()])
    labelled = let(
        softmax(given, names),
        lambda p: F.struct(*[p[n].alias(n) for n in names], most_likely(p, names).alias("most_likely_label")),
    )
    scored = df.withColumn("_topic", labelled)
    return scored.select(*df.columns, *[F.col("_topic")[n].alias(n) for n in [*names, "most_likely_label"]])


def with_most_likely(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``most_likely_label`` from probability columns that a scorer gave."""
    return df.withColumn("most_likely_label", let(F.struct(*names), lambda p: most_likely(p, names)))


def allowed_topics(df: DataFrame, labels=ALLOWED_LABELS) -> DataFrame:
    return df.where(F.col("most_likely_label").isin(*labels))


# -- pollution --------------------------------------------------------------

PairScorer = Callable[[Column, Column], Column]


def label_pollution(
    df: DataFrame,
    key: list[str],
    scorer: PairScorer | BatchScorer = token_containment,
    skip_prob: float = SKIP_PROBABILITY,
    prob_original: float = REPAIR_THRESHOLD,
    seed=0,
    batch_size: int = 64,
    ask: bool = False,
) -> DataFrame:
    """Adds ``yes``, the probability that the rewritten text gives its prompt away.

    A text above ``prob_original`` is scored again without its first line, and
    that text is kept if it scores lower. A share of the rows, chosen by key, is
    not scored at all: those get 0 and ``scored`` is false. ``scorer`` is a
    function of (prompt, text) columns, which must give null for a null text, or a batch scorer that takes ``prompt`` and
    ``text`` and returns ``p``. A batch scorer is set up once per task for both readings, and is handed
    no null texts and only those shorter texts whose score can matter. With ``ask`` a batch scorer is handed the
    whole question, whether the text holds the prompt, as ``text``: what a zero-shot model reads.
    """
    threshold = F.lit(prob_original)
    prompt = F.col("rewrite_prompt")
    marked = df.withColumn("scored", ~bypassed(skip_prob, *key, salt=seed))
    text = F.when(F.col("scored"), F.col("rewritten_text"))

    def outcome(p: Column, shorter: Column, p_shorter: Column) -> Column:
        repaired = F.coalesce((p_shorter < p) & (p > threshold), F.lit(False))
        return F.struct(
            F.when(p.isNull(), F.lit(0.0)).when(repaired, p_shorter).otherwise(p).alias("yes"),
            F.when(repaired, shorter).alias("repaired"),
        )

    if hasattr(scorer, "setup"):
        read = (lambda t: pollution_question(F.coalesce(prompt, F.lit("")), t)) if ask else (lambda t: t)
        shorter = F.when(F.col("scored"), drop_first_line("rewritten_text"))
        score = rescored_column(scorer, "p", prob_original, batch_size)
        scored = marked.withColumn("_p", score({"prompt": prompt, "text": read(text)}, {"text": read(shorter)}))
        labelled = scored.withColumn("_label", outcome(F.col("_p.first"), shorter, F.col("_p.second")))
    else:
        # bound step by step, so that a filter on the label does not repeat the scorer many times over
        def rescored(p: Column) -> Column:
            return let(
                F.when(p > threshold, drop_first_line("rewritten_text")),
                lambda shorter: let(scorer(prompt, shorter), lambda p_shorter: outcome(p, shorter, p_shorter)),
            )

        labelled = marked.withColumn("_label", let(scorer(prompt, text), rescored))
    return labelled.withColumns(
        {"rewritten_text": F.coalesce(F.col("_label.repaired"), F.col("rewritten_text")), "yes": F.col("_label.yes")}
    ).select(*[c for c in df.columns if c != "yes"], "yes", "scored")


def unpolluted(df: DataFrame, threshold: float = POLLUTION_THRESHOLD) -> DataFrame:
    return df.where(F.col("yes") < F.lit(threshold))
