import math
import random
from collections import Counter, defaultdict

import pytest

from quillwork.llm import quality


def symbols(text):
    return ["\2"] * 3 + [c if ord(c) < 65535 else "￿" for c in " ".join(text.split())] + ["\3"]


def plain_model(texts):
    """{order: ({gram: share}, {context: back})} with grams as tuples."""
    top = Counter(tuple(s[k : k + 4]) for t in texts for s in [symbols(t)] for k in range(len(s) - 3))
    counts = {4: top}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    model = {}
    for k in (1, 2, 3, 4):
        n = Counter(counts[k].values())
        y = n[1] / max(n[1] + 2 * n[2], 1)
        d = {j: max(0.1, min(j - 0.05, j - (j + 1) * y * (n[j + 1] / n[j] if n[j] else 0.5))) for j in (1, 2, 3)}
        whole, taken = defaultdict(int), defaultdict(float)
        for g, c in counts[k].items():
            whole[g[:-1]] += c
            taken[g[:-1]] += d[min(c, 3)]
        model[k] = {g: (c - d[min(c, 3)]) / whole[g[:-1]] for g, c in counts[k].items()}, {x: taken[x] / whole[x] for x in whole}
    return model


def plain_perplexity(model, text):
    s, total = symbols(text), 0.0
    for k in range(3, len(s)):
        p = 1 / 65536
        for order in (1, 2, 3, 4):
            gram = tuple(s[k - order + 1 : k + 1])
            p = model[order][0].get(gram, 0.0) + model[order][1].get(gram[:-1], 1.0) * p
        total += math.log(p)
    return math.exp(-total / (len(s) - 3))


def corpus():
    rng = random.Random(3)
    parts = {"aa": ["ba", "do", "é", "ri"], "bb": ["sch", "ung", "漢", "😀"]}
    docs = []
    for i in range(260):
        lang = "aa" if i % 2 else "bb"
        docs.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 25))), lang))
    return docs


@pytest.mark.parametrize("chunk_bytes", [quality.CHUNK_BYTES, 700])
def test_perplexities_match_a_plain_model(spark, chunk_bytes):
    docs = corpus()
    odd = [(900, None, "aa"), (901, " \n", "aa"), (None, docs[0][1], None), (None, docs[0][1], None), (902, "zz " * 20_000, "zz"), (0, docs[0][1], "bb")]
    df = spark.createDataFrame([(*d, 1.0) for d in docs + odd], "doc_id long, text string, lang string, perplexity double").repartition(3)
    trusted = spark.createDataFrame([(d[0],) for d in docs[:220]] + [(None,), (5,)], "doc_id long")
    got = quality.classify(df, trusted, chunk_bytes=chunk_bytes).collect()
    assert len(got) == len(docs) + len(odd)
    import hashlib

    teach = [d for d in docs[:220] + [(0, docs[0][1], "bb")] if hashlib.md5(f"quality|{d[0]}".encode()).hexdigest()[0] not in "012"]
    models = {lang: plain_model([t for _, t, x in teach if lang in ("*", x)]) for lang in ("aa", "bb", "*")}
    want = sorted((str(i), str(lang), round(plain_perplexity(models[lang if lang in ("aa", "bb") else "*"], t), 6)) for i, t, lang in docs + odd if t and t.strip())
    assert sorted((str(r["doc_id"]), str(r["lang"]), round(r["perplexity"], 6)) for r in got if r["perplexity"] is not None) == want
    assert all(not r["keep"] for r in got if r["perplexity"] is None)
    assert all(r["keep"] == (r["perplexity"] <= r["threshold"]) for r in got if r["perplexity"] is not None)
    assert not next(r for r in got if r["doc_id"] == 902)["keep"]


def test_without_trusted_and_empty(spark):
    df = spark.createDataFrame(corpus()[:4] + [(7, None, "aa")], "doc_id long, text string, lang string")
    none = quality.classify(df, df.select("doc_id").limit(0)).collect()
    assert sorted(r["keep"] for r in none) == [False, True, True, True, True]
    assert quality.classify(df.limit(0), df.select("doc_id")).count() == 0


def test_query(spark, sf_dir):
    rows = quality.op2_quality(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert sum(r["keep"] for r in rows) > 0.6 * len(rows)
