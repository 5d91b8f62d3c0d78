import numpy as np

from quillwork.llm import hamming_search as hs


def brute(rows, asked, k):
    longest = max((len(v) for _, v in rows if v), default=0)
    codes = {i: [x is not None and x > 0 for x in v] + [False] * (longest - len(v)) for i, v in rows if i is not None and v}
    out = []
    for q in asked:
        if q in codes:
            near = sorted((sum(a != b for a, b in zip(codes[q], codes[i])), i) for i in codes if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def check(spark, rows, asked, k):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, code int")
    queries = spark.createDataFrame([(a,) for a in asked], "q long")
    got = sorted(map(tuple, hs.top_k(df, queries, k).collect()))
    assert got == brute(dict(rows).items(), set(asked), k)


def test_random_and_clustered(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(5, 40))
    rows = [(int(i), (centre[i % 5] + rng.normal(size=40) * (0.2 if i % 3 else 3)).tolist()) for i in range(120)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    check(spark, rows, [0, 7, 1000, 1005, 119, 5555], 7)


def test_odd_vectors(spark):
    rows = [(1, [1.0, -1.0, 0.0]), (2, None), (3, []), (4, [1.0]), (5, [None, 2.0, 3.0]), (6, [float("nan"), 1.0, -0.0]), (None, [1.0]), (1, [1.0, -1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, hs.top_k(df, spark.createDataFrame([(1,), (2,), (None,)], "q long"), 10).collect()))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 4, 0), (1, 6, 1), (1, 5, 3)]
    assert hs.top_k(df.limit(0), df.select("vec_id").limit(0)).count() == 0
