"""The language table, text vectors, k-means, nearest centres, second scores, generations met by key."""

import hashlib
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillwork.functions import vectors
from quillwork.operators import clustering as C
from quillwork.operators import labeling as L
from quillwork.operators.generation import attach_generations, without_generation
from quillwork.operators.joins import SizeBound, lookup_join
from quillwork.plans.rewrite import select_texts


def bucket(token, digits):
    return hashlib.md5(token.encode()).hexdigest()[:digits]


def plain_probability(taught, text, language, buckets=1 << 16):
    def bucket(token):
        return crc32(token.encode()) % buckets

    tokens, texts = {}, Counter(lang for _, lang in taught)
    for body, lang in taught:
        tokens.setdefault(lang, Counter()).update(bucket(t) for t in body.lower().split(" "))
    scores = {}
    for lang, counts in tokens.items():
        total = math.log(counts.total() + buckets)
        scores[lang] = math.log(texts[lang] / len(taught)) + sum(
            math.log(counts[bucket(t)] + 1) - total for t in text.lower().split(" "))
    top = max(scores.values())
    return math.exp(scores[language] - top) / sum(math.exp(s - top) for s in scores.values())


TAUGHT = [("the cat and the dog", "en"), ("a dog is here", "en"), ("le chat et le chien", "fr"), ("un chien", "fr"), ("der hund", "de"), ("die katze und der hund", "de")]


@pytest.mark.parametrize("small", [True, False])
def test_language_table_is_naive_bayes(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(L, "lookup_join", lambda *a, size=None, **k: lookup_join(*a, bound=SizeBound(0, 0), **k))
    taught = spark.createDataFrame([*TAUGHT, (None, "en"), ("lost text", None)], "original_text string, lang string")
    texts = ["the dog", "THE dog", "le hund", "", "unheard of words", "le chat", "the katze  und", "x " * 3000] + ["der chien"] * 40 + [None]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, original_text string").withColumn("en", F.lit("old")).repartition(3)
    model = L.train_language_model(taught)
    for language in ("en", "fr"):
        got = {r["id"]: r["p"] for r in L.with_language_probability(frame, model, language=language, out_col="p").collect()}
        want = {i: None if t is None else plain_probability(TAUGHT, t, language) for i, t in enumerate(texts)}
        assert set(got) == set(want)
        assert all(got[i] is None if want[i] is None else got[i] == pytest.approx(want[i], abs=1e-9) for i in want)
    replaced = L.with_language_probability(frame, model)
    assert replaced.columns == ["id", "original_text", "en"] and dict(replaced.dtypes)["en"] == "double"
    assert L.with_language_probability(frame.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        L.train_language_model(taught.limit(0))


def test_text_vectors_weigh_rare_tokens_more(spark):
    texts = ["a b", "a c", "a a a d", None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    weights = C.fit_text_weights(frame, "t")
    held = [{bucket(t, 2) for t in x.split(" ")} if x is not None else set() for x in texts]
    for number, name in enumerate(C.bucket_names()):
        assert weights[number] == pytest.approx(math.log(6 / (sum(name in h for h in held) + 1)))
    for row in C.with_text_vector(frame, "t", "v", weights).collect():
        want = np.zeros(256)
        for t in (row["t"].split(" ") if row["t"] is not None else []):
            want[int(bucket(t, 2), 16)] += weights[int(bucket(t, 2), 16)]
        norm = np.linalg.norm(want)
        assert np.allclose(row["v"], want / norm if norm else want, atol=1e-6)


def plain_rounds(points, start, rounds=20):
    centres = np.array(start, float)
    for _ in range(rounds):
        at = [int(np.argmin([round(((p - c) ** 2).sum(), 9) for c in centres])) for p in points]
        moved = np.array([np.mean([p for p, a in zip(points, at) if a == k], axis=0) if k in at else c for k, c in enumerate(centres)])
        if np.allclose(moved, centres, atol=1e-12):
            break
        centres = moved
    return centres


def test_clusters_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(120, 4)).astype(np.float32), np.tile(np.float32([9, 9, 9, 9]), (60, 1))])
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(999, None)]
    frame = spark.createDataFrame(rows, "id long, v array<float>")
    models = [C.fit_clusters(frame.repartition(n), "v", k=6, key=["id"]) for n in (3, 8, 40)]
    assert all(np.array_equal(m.centres, models[0].centres) for m in models[1:])
    order = sorted({tuple(p): min(hashlib.md5(f"centre|42|{len(str(i))}:{i}".encode()).hexdigest() for i, q in enumerate(points) if (q == p).all()) for p in points}.items(), key=lambda x: x[1])
    assert np.allclose(models[0].centres, plain_rounds(points.astype(float), [p for p, _ in order[:6]]), atol=1e-9)
    without_key = [C.fit_clusters(frame.repartition(n), "v", k=3).centres for n in (2, 7)]
    assert np.array_equal(*without_key)
    few = C.fit_clusters(frame.where("id >= 120"), "v", k=6)
    assert few.centres.tolist() == [[9.0] * 4]
    with pytest.raises(ValueError):
        C.fit_clusters(frame.limit(0), "v")


@pytest.mark.parametrize("block_bytes", [C.CENTRE_BYTES, 4000])
def test_nearest_of_many_centres(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(C, "CENTRE_BYTES", block_bytes)
    monkeypatch.setattr(C, "PACKED_ROWS", 50)
    count = 10_000 if block_bytes > 4000 else 300
    rng = np.random.default_rng(4)
    centres, points = rng.normal(size=(count, 3)), rng.normal(size=(200, 3))
    centres[7] = centres[3]
    points[0] = centres[3]
    rows = [(i, p.tolist(), {"k": "v"}) for i, p in enumerate(points)] + [(999, None, None)]
    frame = spark.createDataFrame(rows, "block long, v array<double>, cluster map<string,string>").repartition(3)
    given = spark.createDataFrame(list(enumerate(centres.tolist())), "cluster int, center array<double>").repartition(5)
    found = C.with_nearest_centre(frame, given, "v", "near")
    assert found.columns == [*frame.columns, "near"]
    want = {i: int(np.round(((p - centres) ** 2).sum(axis=1), 9).argmin()) for i, p in enumerate(points)} | {999: None}
    assert {r["block"]: r["near"] for r in found.collect()} == want and want[0] == 3
    assert [r["near"] for r in C.with_nearest_centre(frame, given.limit(0), "v", "near").collect()] == [None] * 201
    assert C.with_nearest_centre(frame.limit(0), given, "v", "near").collect() == []
    with pytest.raises(Exception, match="unequal length"):
        C.with_nearest_centre(spark.createDataFrame([([1.0],)], "v array<double>"), given, "v").collect()


def counted_scorer(path):
    # a local class travels to the workers by value
    class CountedScorer:
        """A score by length; writes a line for each set-up and each text it is handed."""

        def __init__(self, path):
            self.path = path

        def note(self, what):
            with open(self.path, "a") as out:
                out.write(f"{what}\n")

        def setup(self):
            self.note("setup")

        def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
            for text in batch["text"]:
                self.note(f"text {text!r}")
            return pd.DataFrame({"p": [min(len(t), 10) / 10 for t in batch["text"]]})

        def cleanup(self):
            self.note("cleanup")

    return CountedScorer(path)


def test_second_scores_need_one_set_up_and_few_texts(spark, tmp_path):
    rows = [(1, "p", "a long first line\nrest"), (2, "p", "short"), (3, "p", None), (4, "p", "one line that is long"), (5, "p", "long enough\nand still long enough")]
    frame = spark.createDataFrame(rows, "id int, rewrite_prompt string, rewritten_text string").coalesce(1)
    path = str(tmp_path / "log")
    labelled = L.label_pollution(frame, ["id"], counted_scorer(path), skip_prob=0.0)
    assert str(labelled._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") == 1
    got = {r["id"]: (r["rewritten_text"], r["yes"]) for r in labelled.collect()}
    assert got == {1: ("rest", 0.4), 2: ("short", 0.5), 3: (None, 0.0), 4: (rows[3][2], 1.0), 5: (rows[4][2], 1.0)}
    notes = open(path).read().splitlines()
    assert notes.count("setup") == notes.count("cleanup") == 1
    assert sorted(n for n in notes if n.startswith("text")) == sorted(f"text {t!r}" for t in [r[2] for r in rows if r[2]] + ["rest", rows[3][2], "and still long enough"])
    asked = tmp_path / "asked"
    L.label_pollution(frame, ["id"], counted_scorer(str(asked)), skip_prob=0.0, ask=True).collect()
    assert all("contain the information p?" in n for n in asked.read_text().splitlines() if n.startswith("text"))


def test_rows_without_a_generation_stay(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "k int, rewritten_text string")
    finished = spark.createDataFrame([(1, "one"), (1, "one"), (None, "none"), (4, "EMPTY"), (9, "nobody's")], "k int, rewritten_text string")
    out = attach_generations(asked, finished, ["k"], "table", {"output_len": 5})
    assert sorted(((r["k"], r["rewritten_text"]) for r in out.collect()), key=str) == [(1, "one"), (2, None), (None, "none")]
    assert without_generation(out).first()["missing"] == 1
    several = finished.unionByName(spark.createDataFrame([(1, "other")], finished.schema))
    with pytest.raises(Exception, match="several generations"):
        attach_generations(asked, several, ["k"], "table", {}).collect()


def test_only_sampled_rows_are_scored(spark, tmp_path):
    path = str(tmp_path / "seen")

    @F.pandas_udf("double")
    def english(ids: pd.Series) -> pd.Series:
        with open(path, "a") as out:
            out.writelines(f"{i}\n" for i in ids)
        return pd.Series([1.0] * len(ids))

    frame = spark.range(5000).select("id", F.concat(F.lit("text "), "id").alias("original_text"), F.lit("train").alias("split"))
    flat = {n: F.lit(1.0 if n == "story" else 0.0) for n in ("marketing", "tweet", "news", "story")}
    chosen = select_texts(frame, ["id"], lambda df: df.withColumn("en", english("id")), flat, version=1, num_samples=40)
    assert chosen.count() == 40
    assert len(set(open(path).read().split())) == 40
