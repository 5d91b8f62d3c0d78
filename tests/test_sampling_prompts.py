from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillwork.fixed import CATALOGUE
from quillwork.operators.joins import SizeBound
from quillwork.operators.prompts import distinct_prompts, generated_prompts, with_prompt_metadata
from quillwork.operators.sampling import (
    attach_examples,
    bypassed,
    choice,
    draw_prompts,
    prompt_pool,
    requested_splits,
    source_weights,
    split_of,
)

TINY = SizeBound(rows=1, bytes=1)


def bag(frame):
    return Counter(str(tuple(r)) for r in frame.collect())


@pytest.fixture(scope="module")
def prompts(spark):
    rows = [("one", "only prompt", 0)]
    rows += [("ten", f"ten {i}", i % 3) for i in range(10)]
    rows += [("hundred", f"hundred {i}", i % 7) for i in range(100)]
    rows += [("twin", "only prompt", 9), ("twin", "ten 3", 8)]
    return spark.createDataFrame(rows, "source string, rewrite_prompt string, cluster int")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.range(1500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("original_text"))


def test_catalogue_is_every_value_in_every_template(spark):
    want = []
    for family, (values, templates) in CATALOGUE.items():
        for template in templates:
            field = template[template.index("{") : template.index("}") + 1]
            want += [(family, template.replace(field, value)) for value in values]
    got = [tuple(r) for r in generated_prompts(spark).collect()]
    assert Counter(got) == Counter(want) and len(got) == 276
    assert Counter(f for f, _ in got) == {"author": 36, "style": 27, "period": 24, "basic": 15, "improve": 174}


def test_distinct_prompts_keep_a_text_once_per_source(spark):
    a = spark.createDataFrame([("s", "p"), ("s", "p"), ("t", "p")], "source string, rewrite_prompt string")
    assert bag(distinct_prompts(a, a)) == bag(a.limit(0).union(a.distinct()))


def test_metadata_join_multiplies_by_sources(spark, prompts):
    rows = spark.createDataFrame([(1, "only prompt"), (2, "only prompt"), (3, "unknown")], "id int, rewrite_prompt string")
    got = with_prompt_metadata(rows, prompts, ["id"]).select("id", "prompt_source").collect()
    assert Counter(tuple(r) for r in got) == {(1, "one"): 1, (1, "twin"): 1, (2, "one"): 1, (2, "twin"): 1}


def test_weights_sum_to_one_and_sources_are_equal(spark, prompts):
    rows = source_weights(prompts).collect()
    per_source = Counter()
    for r in rows:
        per_source[r["source"]] += r["weight"]
    assert len(rows) == prompts.count()
    assert all(abs(w - 0.25) < 1e-12 for w in per_source.values())


def test_every_source_gets_its_share_of_draws(spark, prompts, texts):
    drawn = draw_prompts(texts, prompt_pool(prompts, keep_drawn_source=True), ["doc_id"], k=4)
    counts = Counter(r["prompt_source"] for r in drawn.select("prompt_source").collect())
    assert sum(counts.values()) == 6000
    assert all(abs(n - 1500) < 150 for n in counts.values())


def test_fan_out_follows_the_number_of_sources(spark, prompts, texts):
    kept = draw_prompts(texts, prompt_pool(prompts, keep_drawn_source=True), ["doc_id"])
    fanned = draw_prompts(texts, prompt_pool(prompts), ["doc_id"])
    shared = kept.where(F.col("rewrite_prompt").isin("only prompt", "ten 3")).count()
    assert shared > 0 and fanned.count() == kept.count() + shared


def test_large_pool_path_draws_the_same(spark, prompts, texts):
    columns = ["doc_id", "draw_no", "original_text", "rewrite_prompt", "prompt_source", "prompt_cluster"]
    for keep in (True, False):
        pool = prompt_pool(prompts, keep)
        small = draw_prompts(texts, pool, ["doc_id"]).select(*columns)
        large = draw_prompts(texts.repartition(11), pool, ["doc_id"], bound=TINY).select(*columns)
        assert bag(small) == bag(large)


@pytest.mark.parametrize("k", [1, 3])
def test_examples_are_the_same_on_both_paths(spark, texts, k):
    pool = spark.range(30).select(
        F.col("id").alias("pool_id"),
        *[F.concat(F.lit(f"{c} "), "id").alias(c) for c in ("original_text", "rewritten_text")],
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("prompt "), "id")).alias("rewrite_prompt"),
    )
    small = attach_examples(texts, pool, ["doc_id"], ["pool_id"], k)
    large = attach_examples(texts, pool, ["doc_id"], ["pool_id"], k, bound=TINY)
    assert bag(small) == bag(large)
    rows = small.collect()
    assert len(rows) == 1500 and all(len(r["examples"]) == k for r in rows)
    assert len({r["examples"][0]["original_text"] for r in rows}) == 30


def test_empty_example_pool_is_an_error(spark, texts):
    pool = texts.select("doc_id", *[F.lit("x").alias(c) for c in ("original_text", "rewritten_text", "rewrite_prompt")])
    with pytest.raises(ValueError):
        attach_examples(texts, pool.where("false"), ["doc_id"], ["doc_id"])


def test_split_shares_and_stability(spark, texts):
    once = {r["doc_id"]: r["s"] for r in texts.select("doc_id", split_of("doc_id").alias("s")).collect()}
    again = {r["doc_id"]: r["s"] for r in texts.repartition(7).select("doc_id", split_of("doc_id").alias("s")).collect()}
    assert once == again
    shares = Counter(once.values())
    assert abs(shares["train"] - 1200) < 60 and abs(shares["validation"] - 150) < 45 and abs(shares["test"] - 150) < 45


def test_choice_and_bypass_shares(spark, texts):
    counts = Counter(r[0] for r in texts.select(choice(3, "doc_id", salt="a")).collect())
    assert set(counts) == {0, 1, 2} and all(abs(n - 500) < 80 for n in counts.values())
    assert abs(texts.where(bypassed(0.5, "doc_id", salt="b")).count() - 750) < 80
    assert texts.where(bypassed(0.0, "doc_id", salt="b")).count() == 0


def test_requested_splits():
    assert requested_splits("all") == ("train", "validation", "test")
    assert requested_splits("test") == ("test",)
    with pytest.raises(ValueError):
        requested_splits("dev")
