import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.llm import toxicity
from quillwork.llm.common import is_held_out

INSULTS = ["grumblefool", "snotnose", "vilewretch"]


def plain_kernel(a, b):
    """Common subsequences of three symbols within five, by all triples of places."""

    def weights(unit):
        text = [toxicity.BEGIN, *(int(toxicity.SYMBOL[ord(c)]) for c in unit if toxicity.SYMBOL[ord(c)] != toxicity.SKIP), toxicity.END]
        found = {}
        for i, j, k in combinations(range(len(text)), 3):
            if k - i <= 4:
                key = text[i], text[j], text[k]
                found[key] = found.get(key, 0) + toxicity.GAP ** (k - i - 2)
        return found

    x, y = weights(a), weights(b)
    return sum(v * y.get(k, 0) for k, v in x.items())


def test_kernel_matches_all_triples():
    landmarks = [("idiot", True), ("loser", True), ("ab", True), ("xx-xx", True)]
    machine = toxicity.Machine(landmarks)
    units = ["idiot", "i-d-iot", "idixot", "loserr", "xxx", "q", ""]
    z, zl = machine.embed(units), machine.embed([u for u, _ in landmarks])
    scale = {u: toxicity.scale([u])[0] for u in units + [u for u, _ in landmarks]}
    for i, u in enumerate(units):
        for j, (m, _) in enumerate(landmarks):
            assert z[i, :-1] @ zl[j, :-1] == pytest.approx(plain_kernel(u, m) / scale[u] / scale[m], abs=1e-4)


def test_table_equals_decision():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(80)]
    machine = toxicity.Machine([(w, True) for w in words[:20]])
    x = machine.embed(words)
    y = np.where(np.arange(80) < 10, 1.0, -1.0)
    machine.train(x, y, np.ones(80))
    assert (machine.decide(words[:10]) > 0).all() and (machine.decide(words[10:20]) < 0).all()


def corpus(n=900):
    rng = random.Random(7)
    words = ["".join(rng.choice(["ba", "do", "ri", "mek", "tu", "lan", "sol", "ve"]) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.3)
        for _ in range(rng.randint(1, 3) * toxic):
            text.insert(rng.randint(0, len(text)), rng.choice(INSULTS))
        docs.append((i, ". ".join(" ".join(text[k : k + 9]) for k in range(0, len(text), 9))))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_and_disguised(spark):
    docs, labels = corpus()
    model = toxicity.learned(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    )
    held = [k for k in range(len(docs)) if is_held_out(k)]
    score = model.score([docs[k][1] for k in held])
    truth = np.array([labels[k][2] for k in held])
    assert ((score >= 0.7) == truth).mean() > 0.97
    bad = model.score(["ba g-r-u-m-b-l-e-f-o-o-l dori snotnose", "ba s n o t n o s e dori vilewretch", "ba grumb1lefool dori sno*tnose"])
    good = model.score(["ba dori meklan", "", "solve tu ri"])
    assert bad.min() > good.max()


def test_odd_rows_and_no_labels(spark, sf_dir):
    docs, labels = corpus(300)
    docs = docs + [(1, docs[1][1]), (5000, None), (5001, ""), (None, "x"), (5002, "w" * 50_000), (5003, "!!! ??")]
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, toxic string")
    lab = spark.createDataFrame([*labels, (1, None, None), (None, 1, 1), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learned(d, lab)
    got = d.select("doc_id", toxicity.toxic_score(F.col("text"), model).alias("score")).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    nothing = toxicity.learned(d, lab.limit(0))
    assert nothing.score(["a", None or ""]).tolist() == [0.0, 0.0]
    assert toxicity.learned(d.limit(0), lab).machine is None
    rows = toxicity.op8_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
