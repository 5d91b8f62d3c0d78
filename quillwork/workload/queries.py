"""One query per operator or job. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillwork.fixed import CORPORA, MAX_WORDS
from quillwork.functions.arrays import regroup
from quillwork.functions.chat import stack_messages
from quillwork.functions.text import after_last, join_texts, or_empty, pollution_question, strip, word_count
from quillwork.functions.vectors import cosine
from quillwork.operators.clustering import centres_frame, fit_text_weights, mean_vectors, with_nearest_centre, with_text_vector
from quillwork.operators.formatting import formatted, with_marker
from quillwork.operators.generation import attach_generations, generate_texts, regroup_rows, with_generation_input
from quillwork.operators.labeling import (
    allowed_topics,
    english_only,
    label_pollution,
    unpolluted,
    with_language_probability,
    with_topic_label,
)
from quillwork.operators.pairs import preference_pairs as pairs_of
from quillwork.operators.prompts import with_prompt_metadata
from quillwork.operators.ranking import sample_per_split, with_group_index, with_runs
from quillwork.operators.sampling import attach_examples, choice, source_weights, split_of
from quillwork.operators.scorers import FunctionScorer
from quillwork.operators.scoring import candidate_summary, score_long, similarity_summary, with_candidate_scores
from quillwork.operators.weighted import draw_weighted, weighted_pool
from quillwork.plans.gather import add_templates, build_prompts, downloaded_texts, gather_texts, row_counts
from quillwork.plans.preference import (
    evaluate,
    extract_response,
    gather_pairs,
    preference_examples,
    score_candidates,
    supervised_examples,
)
from quillwork.plans.rewrite import gather_rewritten, label_rewritten, rewrite_texts, select_texts
from quillwork.schemas import GATHERED
from quillwork.session import materialise, new_folder
from quillwork.sources.corpora import read_known_corpora, read_text_corpus, seen_counts
from quillwork.sources.tables import read_csv_sources
from quillwork.sources.versions import VersionedTables, read_prompts, write_table
from quillwork.workload import inputs
from quillwork.workload.inputs import PAIR_KEY, table

# -- gathering --------------------------------------------------------------


def gather_short_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.texts(spark, sf_dir, max_words=MAX_WORDS)


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = {"train": f"{sf_dir}/documents.parquet", "test": f"{sf_dir}/benchmark.parquet"}
    corpus = read_text_corpus(
        spark, "given/texts", "text", splits=["train", "test"], data_files=files, corpus="given", max_words=MAX_WORDS
    )
    pages = read_text_corpus(
        spark, "given/pages", ["url", "html"], data_files={"train": f"{sf_dir}/pages.parquet"}, corpus="pages"
    )
    return gather_texts([corpus, pages])


def _known_corpora(spark: SparkSession, sf_dir: str) -> str:
    """The given tables as the folders of the eight known corpora; every ninth text is null."""
    root = new_folder(spark, "corpora")
    texts = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("text"), split_of("doc_id").alias("split")
    )
    for number, (corpus, _, keys, splits) in enumerate(CORPORA):
        columns = [keys] if isinstance(keys, str) else keys
        mine = texts.where(F.col("doc_id") % len(CORPORA) == number)
        for split in splits:
            # a corpus with several key columns holds a text in each
            mine.where(F.col("split") == split).select(*[F.col("text").alias(c) for c in columns]).write.parquet(f"{root}/{corpus}/{split}")
    return root


def known_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight known corpora from their folders, gathered."""
    return gather_texts(read_known_corpora(spark, _known_corpora(spark, sf_dir)))


def gather_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, rejected and too long per corpus and split, from the pass that writes the texts."""
    seen: dict = {}
    materialise(gather_texts(read_known_corpora(spark, _known_corpora(spark, sf_dir), seen=seen)), "texts")
    return seen_counts(spark, seen)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(inputs.texts(spark, sf_dir), ["source", "split"])


def sample_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = sample_per_split(inputs.texts(spark, sf_dir), 100, ["doc_id"], seed=1)
    return sampled.select("doc_id", "split", "original_text")


def multi_column_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several columns of a row as one text."""
    joined = table(spark, sf_dir, "documents").select("doc_id", join_texts("source", "lang", "text").alias("original_text"))
    return joined.withColumn("original_length", word_count("original_text"))


# -- prompts ----------------------------------------------------------------


def prompt_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of all sources with duplicates kept: the benchmark is listed twice."""
    benchmark = inputs.benchmark_prompts(spark, sf_dir)
    return inputs.generated_prompts(spark).unionByName(benchmark).unionByName(benchmark)


def prompt_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = inputs.benchmark_prompts(spark, sf_dir)
    return inputs.distinct_prompts(benchmark, benchmark, inputs.generated_prompts(spark))


def prompt_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = source_weights(inputs.prompts(spark, sf_dir))
    return weighted.withColumn("weight", F.round("weight", 12))


def balanced_prompt_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = add_templates(
        inputs.texts(spark, sf_dir), inputs.shared_prompts(spark, sf_dir), ["doc_id"], keep_drawn_source=True
    )
    return drawn.select("doc_id", "draw_no", "rewrite_prompt", "prompt_source", "prompt_cluster")


def templates_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = add_templates(inputs.texts(spark, sf_dir), inputs.shared_prompts(spark, sf_dir), ["doc_id"])
    return drawn.select(
        "doc_id", "draw_no", "split", "original_length", "rewrite_prompt", "prompt_source", "prompt_cluster"
    )


def downloaded_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = downloaded_texts(
        inputs.triples(spark, sf_dir),
        inputs.shared_prompts(spark, sf_dir),
        PAIR_KEY,
        inputs.topic_logits("original_text"),
    )
    return joined.withColumns({name: F.round(name, 6) for name in ("marketing", "tweet", "news", "story")})


def csv_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples through CSV files and back; one file is listed twice."""
    folder = new_folder(spark, "csv")
    frame = inputs.triples(spark, sf_dir).select("original_text", "rewritten_text", "rewrite_prompt")
    frame.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/pairs.csv")
    return read_csv_sources(spark, [("first", folder, ["pairs.csv", "pairs.csv"]), ("second", folder, ["pairs.csv"])])


def weighted_prompt_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two prompts per text, drawn in proportion to their length."""
    prompts = inputs.prompts(spark, sf_dir).withColumn("weight", F.length("rewrite_prompt"))
    pool = weighted_pool(prompts, "weight", ["source", "rewrite_prompt"])
    fields = {"source": "prompt_source", "rewrite_prompt": "rewrite_prompt"}
    return draw_weighted(inputs.texts(spark, sf_dir), pool, ["doc_id"], fields, k=2).select("doc_id", "draw_no", *fields.values())


def prompt_metadata_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = with_prompt_metadata(
        inputs.triples(spark, sf_dir), inputs.shared_prompts(spark, sf_dir), spread=PAIR_KEY
    )
    return joined.select(*PAIR_KEY, "rewrite_prompt", "prompt_source", "prompt_cluster")


# -- selection and generation -----------------------------------------------


def generation_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = add_templates(inputs.texts(spark, sf_dir), inputs.prompts(spark, sf_dir), ["doc_id"])
    filled = with_generation_input(templates, ["doc_id", "draw_no"])
    return filled.select("doc_id", "draw_no", "rewrite_index", "input")


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and topic filters on scores of every text."""
    scored = inputs.texts(spark, sf_dir, heavy=True).withColumn("en", inputs.english_share("original_text"))
    labelled = with_topic_label(english_only(scored), inputs.topic_logits("original_text", F.col("original_length")))
    return allowed_topics(labelled).select("doc_id", "split", "original_text", F.round("en", 6).alias("en"), "most_likely_label")


def select_for_rewriting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample, English, topic: the whole selection."""
    chosen = select_texts(
        inputs.texts(spark, sf_dir),
        ["doc_id"],
        lambda df: df.withColumn("en", inputs.english_share("original_text")),
        inputs.topic_logits("original_text", F.col("original_length")),
        version=3,
        split="all",
        num_samples=200,
    )
    return chosen.select("doc_id", "split", "original_length", F.round("en", 6).alias("en"), "most_likely_label")


def topic_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_topic_label(
        inputs.texts(spark, sf_dir), inputs.topic_logits("original_text", F.col("original_length"))
    )
    return labelled.select(
        "doc_id", "most_likely_label", *[F.round(n, 6).alias(n) for n in ("marketing", "tweet", "news", "story")]
    )


def language_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P(English) of every document from a model of the train split."""
    documents = inputs.texts(spark, sf_dir, heavy=True, row_key=("doc_id", "lang"))
    scored = with_language_probability(documents, inputs.language_model(spark, sf_dir))
    return scored.select("doc_id", "split", F.round("en", 6).alias("en"))


def _echoing_generator(batch: pd.DataFrame) -> pd.DataFrame:
    """Answers with its input and a word count; every seventh count fails."""
    words = batch["input"].str.count(" ") + 1
    answers = batch["input"] + " -> " + words.astype(str) + " words"
    return pd.DataFrame({"rewritten_text": answers.where(words % 7 != 0, "EMPTY")})


def _polluting_generator(batch: pd.DataFrame) -> pd.DataFrame:
    """As above, but every third count repeats the whole instruction in a first line, as models do."""
    words = batch["input"].str.count(" ") + 1
    answer = " -> " + words.astype(str) + " words"
    repeated = batch["input"].str.replace("\n", " ") + "\n" + answer
    answers = batch["input"] + answer.where(words % 3 != 0, repeated)
    return pd.DataFrame({"rewritten_text": answers.where(words % 7 != 0, "EMPTY")})


def batch_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = with_generation_input(
        inputs.texts(spark, sf_dir, heavy=True).withColumn("rewrite_prompt", F.lit("Improve the text.")), ["doc_id"]
    )
    generated = generate_texts(
        filled, FunctionScorer(_echoing_generator), "echo", {"output_len": 100, "top_k": 20}, batch_size=64,
        echoes=True, repeatable=True,
    )
    return generated.select("doc_id", "rewritten_text", "model", "output_len", "top_k")


def table_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations from a table, met by row key."""
    turns = table(spark, sf_dir, "conversations")
    finished = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"),
        F.when(F.length("text") % 5 == 0, "EMPTY").otherwise(F.col("text")).alias("rewritten_text"),
    )
    asked = turns.where(F.col("role") == "user").select(*PAIR_KEY, F.col("text").alias("original_text"))
    return attach_generations(asked, finished, PAIR_KEY, "table", {"output_len": 100})


def rewrite_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Select, render, generate, label and repair, as one chain of jobs; English by the language model."""
    model = inputs.language_model(spark, sf_dir)
    templates = add_templates(inputs.texts(spark, sf_dir, heavy=True), inputs.prompts(spark, sf_dir), ["doc_id"])
    selected = select_texts(
        templates, ["doc_id", "draw_no"], lambda df: with_language_probability(df, model),
        inputs.topic_logits("original_text", F.col("original_length")), version=1, split="all",
    )
    rewritten = rewrite_texts(
        selected, ["doc_id", "draw_no"], FunctionScorer(_polluting_generator), "echo", {"output_len": 100}, echoes=True
    )
    labelled = label_rewritten(rewritten, ["doc_id", "draw_no"])
    return labelled.select(
        "doc_id", "draw_no", "split", "most_likely_label", "rewritten_text", F.round("yes", 6).alias("yes"), "scored"
    )


# -- pollution --------------------------------------------------------------


def pollution_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = label_pollution(inputs.polluted_triples(spark, sf_dir), PAIR_KEY, skip_prob=0.25)
    return unpolluted(labelled).select(*PAIR_KEY, "rewritten_text", F.round("yes", 6).alias("yes"), "scored")


def pollution_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.polluted_triples(spark, sf_dir).select(
        *PAIR_KEY, pollution_question(or_empty("rewrite_prompt"), "rewritten_text").alias("question")
    )


def _counting_scorer(batch: pd.DataFrame) -> pd.DataFrame:
    """The last digit of the word count of what a zero-shot model would read, as tenths."""
    return pd.DataFrame({"p": (batch["text"].str.count(" ") + 1) % 10 / 10})


def pollution_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch scorer that reads the whole question, set up once per task for both readings."""
    polluted = inputs.polluted_triples(spark, sf_dir)
    labelled = label_pollution(polluted, PAIR_KEY, FunctionScorer(_counting_scorer), skip_prob=0.25, ask=True)
    return labelled.select(*PAIR_KEY, "rewritten_text", F.round("yes", 6).alias("yes"), "scored")


def _written_versions(spark: SparkSession, sf_dir: str) -> VersionedTables:
    """Two versions of labelled texts; one was revised, one has no validation split."""
    labelled = materialise(
        label_pollution(inputs.polluted_triples(spark, sf_dir), PAIR_KEY, skip_prob=0.25)
        .withColumn("most_likely_label", F.lit("story"))
        .withColumn("prompt_source", F.lit("drawn"))
        .withColumn("prompt_cluster", F.length("rewrite_prompt") % 10),
        "labelled",
    )
    tables = VersionedTables(spark, new_folder(spark, "versions"))
    kind = "labeled_rewritten_texts"
    tables.write(labelled.withColumn("yes", F.lit(0.0)), kind, 1)
    tables.write(labelled, kind, 1, revise=True)
    tables.write(labelled.drop("scored").where(F.col("split") != "validation"), kind, "downloaded")
    return tables


def versions_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    gathered = gather_rewritten(_written_versions(spark, sf_dir))
    return gathered.withColumn("yes", F.round("yes", 6)).drop("revision")


def written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per version, revision and split, counted by the writes."""
    return _written_versions(spark, sf_dir).counts("labeled_rewritten_texts")


def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the newest revision, and that a version is not replaced unasked."""
    tables = _written_versions(spark, sf_dir)
    newest = tables.read("labeled_rewritten_texts", 1, GATHERED)
    try:
        tables.write(newest, "labeled_rewritten_texts", 1)
        refused = False
    except FileExistsError:
        refused = True
    return row_counts(newest, ["version", "revision", "split"]).withColumn("refused", F.lit(refused))


# -- scores and pairs -------------------------------------------------------


def cosine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = inputs.vector_groups(spark, sf_dir)
    targets = members.where(F.col("place") == 0).select("row_id", F.col("embedding").alias("target"))
    answers = members.where(F.col("place") > 0).select("row_id", "place", F.col("embedding").alias("candidate"))
    return score_long(targets, answers, ["row_id"]).select(
        "row_id", "place", F.round("cosine", 6).alias("cosine"), F.round("cosine_3", 6).alias("cosine_3")
    )


def candidate_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_candidate_scores(inputs.candidates(spark, sf_dir))
    zipped = scored.select("row_id", F.posexplode(F.arrays_zip("predicted", "cosine", "cosine_3")).alias("at", "c"))
    return zipped.select(
        "row_id", "at", F.col("c.predicted").alias("predicted"),
        F.round("c.cosine", 6).alias("cosine"), F.round("c.cosine_3", 6).alias("cosine_3"),
    )


def regrouped_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of a conversation, in order, in groups of three."""
    groups = regroup_rows(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", 3)
    return groups.select("conv_id", "at", *[F.get("group", F.lit(i)).alias(f"answer_{i}") for i in range(3)])


def regrouped_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of a row in groups of three, so the second group is padded."""
    cut = inputs.candidates(spark, sf_dir).select("row_id", F.posexplode(regroup("predicted", 3)).alias("at", "group"))
    return cut.select("row_id", "at", *[F.get("group", F.lit(i)).alias(f"answer_{i}") for i in range(3)])


def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = candidate_summary(with_candidate_scores(inputs.candidates(spark, sf_dir)), ["split"])
    return summary.select(
        "split", F.round("cosine_avg", 6).alias("cosine_avg"), F.round("cosine_std", 6).alias("cosine_std")
    )


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_candidate_scores(inputs.candidates(spark, sf_dir))
    return pairs_of(scored, ["row_id"])


def gathered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored candidates written as versions, then read back and paired."""
    scored = materialise(with_candidate_scores(inputs.candidates(spark, sf_dir)), "scored")
    tables = VersionedTables(spark, new_folder(spark, "versions"))
    for version in (1, 2):
        tables.write(scored.where(F.col("version") == f"v-{version}"), "generated_and_scored_texts", version)
    return gather_pairs(tables, ["original_text"])


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_group_index(inputs.texts(spark, sf_dir), ["split"], ["doc_id"], salt=5).select(
        "split", "doc_id", "id"
    )


def run_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of long and of short turns inside a conversation, and places in a run."""
    turns = table(spark, sf_dir, "conversations").withColumn("long", F.length("text") > 600)
    return with_runs(turns, ["conv_id"], "turn", "long").select("conv_id", "turn", "run", "count")


# -- clusters ---------------------------------------------------------------


def nearest_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of the mean vectors of the labels, numbered in the labels' order."""
    vectors = table(spark, sf_dir, "embeddings")
    number = F.row_number().over(Window.orderBy("label")) - 1  # one row a label
    means = mean_vectors(vectors, "label", "embedding").withColumn("cluster", number)
    return with_nearest_centre(vectors, means, "embedding").select("vec_id", "label", "cluster")


def text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompts' weighted vectors, one row per bucket that is not zero."""
    prompts = inputs.prompts(spark, sf_dir)
    vectors = with_text_vector(prompts, "rewrite_prompt", weights=fit_text_weights(prompts, "rewrite_prompt"))
    long = vectors.select("source", "rewrite_prompt", F.posexplode("embeddings").alias("bucket", "share"))
    return long.where("share <> 0").withColumn("share", F.round(F.col("share").cast("double"), 6))


def prompt_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt table and the centres, written and read back; each prompt's cluster, and that of the stored centres."""
    clustered, model = build_prompts(inputs.benchmark_prompts(spark, sf_dir))
    folder = new_folder(spark, "prompts")
    write_table(clustered, f"{folder}/prompts")
    write_table(centres_frame(spark, model), f"{folder}/centres")
    norm = F.round(F.sqrt(F.aggregate("embeddings", F.lit(0.0), lambda n, x: n + x * x)), 4)
    prompts = with_nearest_centre(read_prompts(spark, f"{folder}/prompts"), read_prompts(spark, f"{folder}/centres"), "embeddings", "_nearest")
    return prompts.select(
        "source", "rewrite_prompt", F.size("embeddings").alias("size"), norm.alias("norm"), "cluster", F.col("_nearest").alias("nearest"),
    )


# -- formats ----------------------------------------------------------------


def base_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.triples(spark, sf_dir).select(
        *PAIR_KEY,
        formatted("base", PAIR_KEY).alias("drawn"),
        formatted("base", PAIR_KEY, rewrite_prompt=None, template_index=1).alias("fixed_without_answer"),
    )


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.triples(spark, sf_dir).select(
        *PAIR_KEY,
        *[
            formatted(style, PAIR_KEY).alias(style.replace("-", "_"))
            for style in ("gemma-it", "mistral-it", "llama-chat")
        ],
    )


def message_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.split_triples(spark, sf_dir)
    pool = materialise(rows.where(F.col("split") == "test"), "pool")
    rows = attach_examples(rows, pool, PAIR_KEY, PAIR_KEY, k=2)
    return rows.select(
        *PAIR_KEY,
        formatted("gemma-message-stack", PAIR_KEY, examples="examples", system="mock").alias("gemma"),
        formatted("mistral-message-stack", PAIR_KEY, examples="examples", system="none").alias("mistral"),
        formatted("llama-message-stack", PAIR_KEY, examples="examples", system="system").alias("llama"),
    )


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages themselves, one row per turn, with an example given as a value."""
    example = F.struct(
        F.lit("Good day").alias("original_text"), F.lit("Ahoy").alias("rewritten_text"),
        F.lit("Talk like a sailor").alias("rewrite_prompt"),
    )
    messages = stack_messages(
        "original_text", "rewritten_text", "rewrite_prompt", F.array(example), "mock", choice(2, *PAIR_KEY, salt="s")
    )
    turns = inputs.triples(spark, sf_dir).select(*PAIR_KEY, F.posexplode(messages).alias("at", "m"))
    return turns.select(*PAIR_KEY, "at", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def open_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs for generation, cut at the response marker."""
    rows = inputs.triples(spark, sf_dir).select(
        *PAIR_KEY, formatted("gemma-it", PAIR_KEY, rewrite_prompt=None, open_answer=True).alias("input")
    )
    return with_marker(rows, "gemma-it")


def sft_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supervised_examples(
        inputs.split_triples(spark, sf_dir), "mistral-message-stack", PAIR_KEY, num_examples=2, system="mock"
    )


def dpo_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = pairs_of(with_candidate_scores(inputs.candidates(spark, sf_dir)), ["row_id"])
    return preference_examples(pairs, "gemma-it", ["version", "id", "split"])


# -- evaluation -------------------------------------------------------------


def response_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer found again in a decoded text, for a plain and for a control-token marker."""
    rows = inputs.triples(spark, sf_dir).withColumn(
        "padded", F.concat(F.lit("  "), "rewrite_prompt", F.lit(" \n "))
    )
    llama = formatted("llama-chat", PAIR_KEY, rewrite_prompt="padded")
    decoded = F.replace(
        F.replace(formatted("gemma-message-stack", PAIR_KEY, rewrite_prompt="padded"), F.lit("<start_of_turn>"), F.lit("")),
        F.lit("<end_of_turn>"), F.lit(""),
    )
    return rows.select(
        *PAIR_KEY,
        extract_response(llama, "llama-chat").alias("llama"),
        extract_response(decoded, "gemma-message-stack").alias("gemma"),
        strip(after_last("padded", "no such marker")).alias("without_marker"),
    )


def evaluate_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean similarity of answers to the targets of their rows, per place."""
    members = inputs.vector_groups(spark, sf_dir)
    targets = members.where(F.col("place") == 0).select("row_id", F.col("embedding").alias("target"))
    answers = members.where(F.col("place") > 0).select("row_id", "place", F.col("embedding").alias("answer"))
    summary = similarity_summary(answers.join(targets, "row_id"), cosine("answer", "target"), ["place"])
    return summary.select(
        "place", F.round("similarity", 6).alias("similarity"), F.round("similarity_3", 6).alias("similarity_3")
    )


def _counting_decoder(batch: pd.DataFrame) -> pd.DataFrame:
    """Returns what a decoder would: the input, then an answer that depends on it."""
    words = batch["input"].str.count(" ") + 1
    return pd.DataFrame({"decoded": batch["input"] + " Rewrite it, in " + words.astype(str) + " words. \n"})


def evaluate_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few-shot inputs, generation, extraction, vectors and both means, as one job."""
    summary = evaluate(
        inputs.split_triples(spark, sf_dir), "mistral-message-stack", PAIR_KEY, FunctionScorer(_counting_decoder),
        embed=inputs.with_text_features, num_examples=2, system="mock", open_answer=True,
    )
    return summary.select(
        "split", F.round("similarity", 6).alias("similarity"), F.round("similarity_3", 6).alias("similarity_3")
    )


def _four_candidates(batch: pd.DataFrame) -> pd.DataFrame:
    """Every fourth word of the input, from four starts."""
    words = batch["input"].str.split(" ")
    return pd.DataFrame({"predicted": [[" ".join(w[i::4]) for i in range(4)] for w in words]})


def score_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format without answer, generate four candidates, embed and score them."""
    scored = score_candidates(
        inputs.split_triples(spark, sf_dir), "gemma-it", PAIR_KEY, FunctionScorer(_four_candidates),
        {"top_k": 40, "num_return_sequences": 4}, embed=inputs.with_text_features,
    )
    long = scored.select(
        *PAIR_KEY, "split", "top_k", F.posexplode(F.arrays_zip("predicted", "cosine", "cosine_3")).alias("at", "s")
    )
    return long.select(
        *PAIR_KEY, "split", "top_k", "at", F.col("s.predicted").alias("predicted"),
        F.round("s.cosine", 6).alias("cosine"), F.round("s.cosine_3", 6).alias("cosine_3"),
    )


QUERIES = {
    function.__name__: function
    for function in [
        gather_short_texts, corpus_files, known_corpora, gather_counts, split_counts, sample_by_split, multi_column_text,
        prompt_catalogue, prompt_union_distinct, prompt_weights, balanced_prompt_draw, templates_join,
        downloaded_triples, csv_triples, prompt_metadata_join, weighted_prompt_draw,
        generation_inputs, quality_filter, select_for_rewriting, topic_label, language_score,
        batch_generate, table_generate, rewrite_job,
        pollution_repair, pollution_questions, pollution_batch, versions_union, latest_revision, written_counts,
        cosine_scores, candidate_arrays, regrouped_answers, regrouped_arrays, score_summary, preference_pairs, gathered_pairs,
        row_ids, run_positions, nearest_centre, text_vectors, prompt_clusters,
        base_format, chat_format, message_stack, chat_turns, open_inputs, sft_examples, dpo_examples,
        response_extraction, evaluate_similarity, evaluate_answers, score_job,
    ]
}

