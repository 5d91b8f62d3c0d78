import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.functions.arrays import array_stddev_pop, regroup
from quillwork.functions.hashing import digest, uniform
from quillwork.functions.vectors import candidate_cosines, cosine, nearest
from quillwork.operators.clustering import fit_clusters
from quillwork.operators.joins import SizeBound
from quillwork.operators.pairs import preference_pairs, unpaired
from quillwork.operators.ranking import sample_per_split, with_group_index
from quillwork.operators.sampling import attach_examples, bypassed, draw_prompts, prompt_pool, split_of
from quillwork.operators.scoring import candidate_summary
from quillwork.plans.preference import embed_candidates

BOUNDS = [SizeBound(), SizeBound(rows=2)]


def test_draws_for_different_purposes_are_independent(spark):
    rows = spark.range(20_000).withColumn("split", F.lit("train"))
    sampled = sample_per_split(rows, 1500, ["id"], seed=0)
    skipped = sampled.where(bypassed(0.5, "id", salt=0)).count()
    assert 600 < skipped < 900
    test = rows.where(split_of("id", seed=0) == "test")
    assert 0.4 < test.where(bypassed(0.5, "id", salt=0)).count() / test.count() < 0.6
    first = with_group_index(rows, [], ["id"], salt=0, index_col="at").where("at < 2000")
    assert 800 < first.where(bypassed(0.5, "id", salt=0)).count() < 1200


def test_digest_tells_keys_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("", "a"), ("a", ""), (None, None)]
    got = spark.createDataFrame(rows, "x string, y string").select(digest("s", "x", "y").alias("d"), uniform(digest("s", "x")).alias("u")).collect()
    assert len({r["d"] for r in got}) == len(rows) and all(0 <= r["u"] < 1 for r in got)


@pytest.mark.parametrize("shared", [True, False])
def test_both_ways_of_drawing_give_the_same_rows(spark, shared):
    prompts = spark.createDataFrame(
        [(f"s{k}", f"text {j}" if shared else f"text {k} {j}") for k in range(100) for j in range(3)] + [(None, "lost"), ("s1", None)],
        "source string, rewrite_prompt string",
    )
    texts = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d"), (2, "d")], "key long, text string")
    pool = prompt_pool(prompts)
    assert pool.prompts.count() == pool.metadata.count() == 300 == pool.size.rows
    ways = [sorted(map(str, draw_prompts(texts, pool, ["key"], 2, bound=b).collect())) for b in BOUNDS]
    assert ways[0] == ways[1] and len(ways[0]) == (1000 if shared else 10)


def test_both_ways_of_attaching_examples_give_the_same_rows(spark):
    pool = spark.createDataFrame([(k, f"o{k}", f"r{k}", f"p{k}") for k in range(9)], "id long, original_text string, rewritten_text string, rewrite_prompt string")
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "key long, text string")
    ways = [sorted(map(str, attach_examples(rows, pool, ["key"], ["id"], 2, bound=b).collect())) for b in BOUNDS]
    assert ways[0] == ways[1] and len(ways[0]) == 4


@pytest.mark.parametrize("digits", [0, 4])
def test_null_groups_are_numbered(spark, digits):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, k long")
    got = with_group_index(rows, ["g"], ["k"], digits=digits).collect()
    assert sorted((str(r["g"]), r["id"]) for r in got) == [("None", 0), ("None", 1), ("a", 0)]


def test_vectors_that_are_null_or_ragged(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), (None, [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in rows.coalesce(1).select(cosine("a", "b")).collect()] == [1.0, None, 0.0]
    ragged = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0]), ([3.0, 4.0, 5.0, 6.0], [1.0, 2.0])], "a array<float>, b array<float>").coalesce(1)
    with pytest.raises(Exception, match="unequal length"):
        ragged.select(cosine("a", "b")).collect()
    lists = spark.createDataFrame(
        [([[1.0, 0.0], None], [1.0, 0.0]), (None, [1.0, 0.0]), ([], [1.0, 0.0]), ([[1.0, 0.0]], None)], "c array<array<float>>, t array<float>"
    ).coalesce(1)
    got = [r[0] and r[0]["cosine"] for r in lists.select(candidate_cosines("c", "t")).collect()]
    assert got == [[1.0, None], None, [], None]


def test_nearest_over_blocks_of_centres(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres, points = rng.normal(size=(7, 3)), rng.normal(size=(40, 3))
    df = spark.createDataFrame([(p.tolist(),) for p in points] + [(None,)], "v array<double>").coalesce(1)
    whole = [r[0] for r in df.select(nearest("v", centres.tolist())).collect()]
    monkeypatch.setattr("quillwork.functions.vectors.CENTRE_BYTES", 48)
    assert whole == [r[0] for r in df.select(nearest("v", centres.tolist())).collect()]
    assert whole[:-1] == ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1).tolist() and whole[-1] is None


def test_empty_arrays(spark):
    rows = spark.createDataFrame([("x", []), ("y", [1.0, 3.0])], "split string, cosine array<double>")
    got = {r["split"]: (r["cosine_avg"], r["cosine_std"]) for r in candidate_summary(rows, ["split"]).collect()}
    assert got == {"x": (None, None), "y": (2.0, 1.0)}
    assert rows.select(array_stddev_pop("cosine")).collect()[0][0] is None
    nested = spark.createDataFrame([([],), ([[1.0], [2.0], [3.0]],)], "v array<array<double>>")
    assert [r[0] for r in nested.select(regroup("v", 2)).collect()] == [[], [[[1.0], [2.0]], [[3.0], None]]]


def test_rows_without_candidates_stay(spark):
    rows = spark.createDataFrame([(1, None, "p"), (2, [], "p"), (3, ["a b", "c"], "p"), (None, ["d"], "p")], "key long, predicted array<string>, rewrite_prompt string")
    got = {r["key"]: len(r["predicted_vectors"]) for r in embed_candidates(rows, ["key"]).collect()}
    assert got == {1: 0, 2: 0, 3: 2, None: 1}


def test_pairs_and_what_gives_none(spark):
    rows = spark.createDataFrame(
        [("v", None, "a", ["x", "y"], [0.1, 0.2]), ("v", "train", "b", ["x", "y"], [None, None]), ("v", "train", "c", None, None)],
        "version string, split string, original_text string, predicted array<string>, cosine array<double>",
    ).withColumns({c: F.lit("-") for c in ("rewritten_text", "rewrite_prompt", "source")})
    pairs = preference_pairs(rows, ["original_text"]).collect()
    assert [(p["chosen"], p["rejected"], p["split"]) for p in pairs] == [("y", "x", None)]
    assert {(r["split"], r["rows"], r["unpaired"]) for r in unpaired(rows).collect()} == {(None, 1, 0), ("train", 2, 2)}


def test_clusters_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, embeddings array<double>")
    centres = [np.array(fit_clusters(df.repartition(n), k=6).clusterCenters()) for n in (1, 7)]
    assert np.allclose(centres[0], centres[1])
