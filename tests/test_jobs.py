import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillwork.operators.clustering import centres_frame, fit_clusters, with_cluster, with_nearest_centre
from quillwork.operators.pairs import preference_pairs
from quillwork.operators.scorers import FunctionScorer
from quillwork.operators.scoring import candidate_summary, similarity_summary
from quillwork.plans.gather import build_prompts, downloaded_texts
from quillwork.plans.preference import evaluate, gather_pairs, preference_examples, score_candidates, supervised_examples
from quillwork.plans.rewrite import gather_rewritten, label_rewritten, rewrite_texts, select_texts
from quillwork.session import new_folder
from quillwork.sources.versions import VersionedTables

SCORED = (
    "row int, split string, version string, original_text string, rewritten_text string, rewrite_prompt string,"
    " source string, predicted array<string>, cosine array<double>, cosine_3 array<double>"
)


def scored(spark, lists):
    rows = [
        (i, "train" if i % 2 else "test", "v-1", f"o{i}", f"r{i}", f"p{i}", "s", [f"c{i}.{j}" for j in range(len(c))], c, c)
        for i, c in enumerate(lists)
    ]
    return spark.createDataFrame(rows, SCORED)


def test_pairs_leave_out_the_first_best(spark):
    lists = [[0.1, 0.9, 0.9], [0.5], [], [0.2, float("nan"), 0.9], [3.0, 2.0, 1.0, 0.0]]
    pairs = preference_pairs(scored(spark, lists), ["row"]).collect()
    assert len(pairs) == sum(max(len(c) - 1, 0) for c in lists)
    got = {}
    for r in pairs:
        got.setdefault((r["original_text"], r["chosen"]), set()).add(r["rejected"])
    assert got == {
        ("o0", "c0.1"): {"c0.0", "c0.2"}, ("o3", "c3.1"): {"c3.0", "c3.2"}, ("o4", "c4.0"): {"c4.1", "c4.2", "c4.3"},
    }


def test_pair_ids_are_dense_per_version_and_split(spark):
    frame = scored(spark, [[0.1, 0.2]] * 20)
    pairs = preference_pairs(frame.unionByName(frame.withColumn("version", F.lit("v-2"))), ["row"])
    ids = {}
    for r in pairs.collect():
        ids.setdefault((r["version"], r["split"]), []).append(r["id"])
    assert {k: sorted(v) for k, v in ids.items()} == {
        (v, s): list(range(10)) for v in ("v-1", "v-2") for s in ("train", "test")
    }


def test_gather_pairs_over_versions(spark):
    tables = VersionedTables(spark, new_folder(spark, "pairs"))
    frame = scored(spark, [[0.1, 0.2], [0.3, 0.1, 0.2]])
    tables.write(frame, "generated_and_scored_texts", 1)
    tables.write(frame.where("split = 'test'"), "generated_and_scored_texts", "downloaded")
    pairs = gather_pairs(tables, ["original_text"])
    assert sorted((r["version"], r["rejected"]) for r in pairs.collect()) == [
        ("v-1", "c0.0"), ("v-1", "c1.1"), ("v-1", "c1.2"), ("v-downloaded", "c0.0"),
    ]
    texts = preference_examples(pairs, "gemma-it", ["version", "split", "id"]).collect()
    assert all(r["chosen"] != r["rejected"] and r["prompt"].endswith("model\n<end_of_turn>\n") for r in texts)


def test_summaries(spark):
    frame = scored(spark, [[0.0, 1.0], [1.0, 1.0, 1.0, 1.0]]).withColumn("split", F.lit("train"))
    row = candidate_summary(frame, ["split"]).first()
    assert row["cosine_avg"] == pytest.approx(5 / 6) and row["cosine_std"] == pytest.approx(0.25)
    row = similarity_summary(spark.createDataFrame([(0.5,), (-1.0,)], "s double"), "s", []).first()
    assert row["similarity"] == pytest.approx(-0.25) and row["similarity_3"] == pytest.approx((0.125 - 1) / 2)


def triples(spark, n=120):
    return spark.range(n).select(
        F.col("id").alias("key"),
        F.concat(F.lit("original text number "), "id").alias("original_text"),
        F.concat(F.lit("rewritten\ntext number "), "id").alias("rewritten_text"),
        F.concat(F.lit("prompt "), F.col("id") % 7).alias("rewrite_prompt"),
        F.concat(F.lit("source "), F.col("id") % 3).alias("source"),
        F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 == 7, "validation").otherwise("test").alias("split"),
    )


def test_prompt_job_and_downloaded_texts(spark):
    data = triples(spark)
    prompts, model = build_prompts(data.select("source", "rewrite_prompt"), k=5)
    rows = prompts.collect()
    assert len(rows) == 276 + 21
    assert {r["cluster"] for r in rows} <= set(range(5)) and len(rows[0]["embeddings"]) == 256
    nearest = with_nearest_centre(prompts.drop("cluster"), [c.tolist() for c in model.clusterCenters()]).collect()
    assert {(r["source"], r["rewrite_prompt"]): r["cluster"] for r in nearest} == {
        (r["source"], r["rewrite_prompt"]): r["cluster"] for r in rows
    }
    assert centres_frame(spark, model).count() == 5
    again = with_cluster(prompts.drop("cluster"), fit_clusters(prompts, k=5))
    assert {r["cluster"] for r in again.collect()} == {r["cluster"] for r in rows}

    logits = {n: F.length("original_text") * w for n, w in [("marketing", 0.1), ("tweet", 0.2), ("news", 0.0), ("story", 0.0)]}
    out = downloaded_texts(data.drop("split"), prompts, ["key"], logits).collect()
    assert len(out) == 120 * 3  # each prompt is held by three sources
    assert {r["most_likely_label"] for r in out} == {"tweet"}


def test_rewrite_chain_to_gathered_texts(spark):
    data = triples(spark).drop("rewritten_text").withColumn("prompt_source", F.col("source")).withColumn(
        "prompt_cluster", F.lit(1)
    )
    flat = {n: F.lit(1.0 if n == "story" else 0.0) for n in ("marketing", "tweet", "news", "story")}
    selected = select_texts(
        data, ["key"], lambda df: df.withColumn("en", F.when(F.col("key") % 2 == 0, 1.0).otherwise(0.5)), flat, version=2,
        split="all", num_samples=30,
    )
    assert selected.groupBy("split").count().collect()
    assert all(r["key"] % 2 == 0 for r in selected.collect())

    def generate(batch):
        return pd.DataFrame({"rewritten_text": "Sure, " + batch["input"].str[21:30] + "\nbody"})

    rewritten = rewrite_texts(selected, ["key"], FunctionScorer(generate), "stub", {"output_len": 100, "top_k": 20})
    assert {"input", "rewrite_index", "model", "output_len", "top_k"} <= set(rewritten.columns)
    tables = VersionedTables(spark, new_folder(spark, "chain"))
    for version in (1, 2):
        tables.write(label_rewritten(rewritten, ["key"], seed=version), "labeled_rewritten_texts", version)
    gathered = gather_rewritten(tables)
    assert {r["version"] for r in gathered.collect()} == {"v-1", "v-2"}
    assert gathered.where("yes >= 0.5").count() == 0


def test_supervised_examples(spark):
    data = triples(spark)
    rows = supervised_examples(data, "gemma-message-stack", ["key"], num_examples=2, system="mock").collect()
    assert len(rows) == 120
    for r in rows:
        assert r["input"].count("Original Text:") == 3 and r["input"].count("<start_of_turn>user") == 7
    plain = supervised_examples(data, "base", ["key"])
    assert plain.columns == ["key", "split", "input"] and plain.count() == 120


def test_scoring_a_perfect_candidate(spark):
    def candidates(batch):
        return pd.DataFrame({"predicted": [["prompt 3", "something else"]] * len(batch)})

    rows = score_candidates(
        triples(spark).where("rewrite_prompt = 'prompt 3'"), "mistral-it", ["key"], FunctionScorer(candidates), {"top_k": 40}
    ).collect()
    assert rows and all(r["cosine"][0] == pytest.approx(1.0, abs=1e-6) and r["cosine"][1] < 0.9 for r in rows)


def test_evaluation_of_a_perfect_decoder(spark):
    data = triples(spark).withColumn("rewrite_prompt", F.lit("rewrite as a poem"))

    def decode(batch):
        return pd.DataFrame({"decoded": batch["input"] + "  rewrite as a poem \n"})

    options = dict(num_examples=1, system="mock", open_answer=True)
    row = evaluate(data, "mistral-message-stack", ["key"], FunctionScorer(decode), **options).collect()
    assert len(row) == 1 and row[0]["split"] == "validation"
    assert row[0]["similarity"] == pytest.approx(1.0, abs=1e-6)
    sized = evaluate(data, "mistral-message-stack", ["key"], FunctionScorer(decode), validation_size=500, **options)
    assert sized.first()["similarity_3"] == pytest.approx(1.0, abs=1e-6)
