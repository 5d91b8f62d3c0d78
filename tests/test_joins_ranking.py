from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from quillwork.operators.joins import SizeBound, lookup_join, measure, salted_join
from quillwork.operators.ranking import sample_per_split, with_group_index, with_runs


def bag(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, a key with two lookup rows, null and unmatched keys."""
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 40}") for i in range(3000)]
    big = spark.createDataFrame(rows, "id int, k string")
    lookup = spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(30)] + [("absent", 0)], "k string, v int"
    )
    return big, lookup


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_gives_the_rows_of_a_plain_join(spark, skewed, how):
    big, lookup = skewed
    want = bag(big.join(lookup, ["k"], how).select("k", "id", "v"))
    assert bag(salted_join(big, lookup, ["k"], ["id"], how).select("k", "id", "v")) == want
    assert bag(lookup_join(big, lookup, ["k"], ["id"], how).select("k", "id", "v")) == want
    tiny = SizeBound(rows=1, bytes=1)
    assert bag(lookup_join(big, lookup, ["k"], ["id"], how, bound=tiny).select("k", "id", "v")) == want


def test_salted_join_splits_the_hot_key(spark, skewed):
    big, lookup = skewed
    plan = salted_join(big, lookup, ["k"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_measure_counts_rows_and_bytes(spark):
    frame = spark.createDataFrame([("ab", 1), ("é", 2), (None, 3)], "t string, n int")
    size = measure(frame)
    assert size.rows == 3 and size.bytes == 2 + 2 + 3 * 8


@pytest.mark.parametrize("digits", [0, 1, 4])
def test_group_index_is_dense_and_independent_of_layout(spark, digits):
    rows = [("hot" if i % 3 else f"g{i % 5}", i) for i in range(900)]
    frame = spark.createDataFrame(rows, "g string, i int")
    plain = {(r["g"], r["i"]): r["id"] for r in with_group_index(frame, ["g"], ["i"], digits=0).collect()}
    other = {
        (r["g"], r["i"]): r["id"]
        for r in with_group_index(frame.repartition(16, "i"), ["g"], ["i"], digits=digits).collect()
    }
    assert plain == other
    sizes = Counter(g for g, _ in plain)
    for g, size in sizes.items():
        assert sorted(v for (h, _), v in plain.items() if h == g) == list(range(size))


def test_group_index_over_everything(spark):
    frame = spark.range(500)
    assert sorted(r["n"] for r in with_group_index(frame, [], ["id"], index_col="n").collect()) == list(range(500))


@pytest.mark.parametrize("n", [1, 7, 60, 5000])
@pytest.mark.parametrize("digits", [1, 2, 4])
def test_sample_per_split_is_exact(spark, n, digits):
    frame = spark.range(600).withColumn(
        "split", F.when(F.col("id") % 10 < 8, "train").when(F.col("id") % 10 == 8, "validation").otherwise("other")
    )
    got = sample_per_split(frame, n, ["id"], seed=3, digits=digits).collect()
    sizes = Counter(r["split"] for r in got)
    assert sizes == {"train": min(n, 480), "validation": min(n, 60)}
    again = sample_per_split(frame.repartition(13), n, ["id"], seed=3, digits=4).collect()
    assert {r["id"] for r in got} == {r["id"] for r in again}


def test_sample_depends_on_the_seed(spark):
    frame = spark.range(600).withColumn("split", F.lit("train"))
    first = {r["id"] for r in sample_per_split(frame, 50, ["id"], seed=1).collect()}
    second = {r["id"] for r in sample_per_split(frame, 50, ["id"], seed=2).collect()}
    assert first != second


def test_sample_refuses_less_than_one(spark):
    with pytest.raises(ValueError):
        sample_per_split(spark.range(3).withColumn("split", F.lit("train")), 0, ["id"])


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_runs_do_not_depend_on_the_chunk(spark, chunk):
    values = {"a": "xxyyyyyyyyyyyyzxxx", "b": "q", "c": "xyxyxy", "d": "zzzzzzzzzzzzzzzzzzzzzzzzz"}
    rows = [(k, 2 * i, v) for k, text in values.items() for i, v in enumerate(text)]  # gaps in the positions
    got = {
        (r["k"], r["i"]): (r["run"], r["count"])
        for r in with_runs(spark.createDataFrame(rows, "k string, i int, v string"), ["k"], "i", "v", chunk=chunk).collect()
    }
    want = {}
    for k, text in values.items():
        i = 0
        for number, (_, members) in enumerate(groupby(text), start=1):
            for place, _ in enumerate(members):
                want[(k, 2 * i)] = (number, place)
                i += 1
    assert got == want


def test_null_starts_a_run(spark):
    frame = spark.createDataFrame([(0, None), (1, None), (2, "a"), (3, "a")], "i int, v string")
    got = [(r["run"], r["count"]) for r in with_runs(frame, [], "i", "v").orderBy("i").collect()]
    assert got == [(1, 0), (2, 0), (3, 0), (3, 1)]
