import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.functions import arrays as A
from quillwork.functions import vectors as V
from quillwork.operators.generation import regroup_rows


def one(spark, row, schema, column):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "scores", [[0.1, 0.9, 0.9], [1.0], [0.3, float("nan"), 0.9], [-1.0, -2.0], [float("nan"), float("nan")]]
)
def test_argmax_is_first_maximum(spark, scores):
    assert one(spark, (scores,), "s array<double>", A.argmax("s")) == int(np.array(scores).argmax())


@pytest.mark.parametrize("n", [1, 2, 3, 5])
@pytest.mark.parametrize("items", [[], ["a"], list("abcd"), list("abcdefg")])
def test_regroup_pads_with_nulls(spark, items, n):
    want = [items[i : i + n] + [None] * (n - len(items[i : i + n])) for i in range(0, len(items), n)]
    assert one(spark, (items,), "s array<string>", A.regroup("s", n)) == want


def test_regroup_rows_equals_regroup(spark):
    rows = [(k, i, f"{k}{i}") for k, size in [("a", 7), ("b", 3), ("c", 1)] for i in range(size)]
    frame = spark.createDataFrame(rows, "k string, i int, v string")
    got = {(r["k"], r["at"]): r["g"] for r in regroup_rows(frame, ["k"], "i", "v", 3, "g").collect()}
    assert got == {
        ("a", 0): ["a0", "a1", "a2"], ("a", 1): ["a3", "a4", "a5"], ("a", 2): ["a6", None, None],
        ("b", 0): ["b0", "b1", "b2"], ("c", 0): ["c0", None, None],
    }


def test_spread_is_population(spark):
    values = [0.2, 0.4, 0.9, 0.1]
    assert math.isclose(one(spark, (values,), "s array<double>", A.array_stddev_pop("s")), np.std(values))
    assert one(spark, ([0.5],), "s array<double>", A.array_stddev_pop("s")) == 0.0


def test_let_evaluates_body_of_value(spark):
    assert one(spark, (3,), "x int", A.let(F.col("x") + 1, lambda y: y * y)) == 16


def test_cosines_match_numpy_and_zero_vector_gives_zero(spark):
    rng = np.random.default_rng(1)
    rows = [(rng.normal(size=8).tolist(), rng.normal(size=8).tolist()) for _ in range(50)] + [([0.0] * 8, [1.0] * 8)]
    frame = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = frame.select("a", "b", V.cosine("a", "b").alias("c"), V.cosine_of_cubes("a", "b").alias("k")).collect()
    for row in got:
        a, b = np.array(row["a"]), np.array(row["b"])
        for x, y, value in [(a, b, row["c"]), (a**3, b**3, row["k"])]:
            norm = max(np.linalg.norm(x), 1e-8) * max(np.linalg.norm(y), 1e-8)
            assert abs(x @ y / norm - value) < 1e-9


def test_candidate_cosines_allow_unequal_lists(spark):
    rows = [([[1.0, 0.0], [1.0, 1.0], [0.0, 0.0]], [1.0, 0.0]), ([], [1.0, 0.0]), ([[0.0, 2.0]], [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "c array<array<double>>, t array<double>").coalesce(1)
    got = [r["s"] for r in frame.select(V.candidate_cosines("c", "t").alias("s")).collect()]
    assert [len(s["cosine"]) for s in got] == [3, 0, 1]
    assert np.allclose(got[0]["cosine"], [1.0, 2**-0.5, 0.0])
    assert np.allclose(got[2]["cosine_3"], [1.0])


def test_nearest_takes_first_of_equal_centres(spark):
    frame = spark.createDataFrame([([0.0, 0.0],), ([3.0, 0.0],), ([1.0, 0.0],)], "v array<double>")
    got = [r[0] for r in frame.select(V.nearest("v", [[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]])).collect()]
    assert got == [0, 1, 0]


def test_unequal_vectors_are_an_error(spark):
    frame = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>").coalesce(1)
    with pytest.raises(Exception, match="unequal length"):
        frame.select(V.cosine("v", "v")).collect()
