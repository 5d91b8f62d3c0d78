import random
from itertools import product

import numpy as np
import pyarrow as pa

from quillwork.llm import language
from quillwork.llm.common import is_held_out

SYLLABLES = {"aa": ["ka", "ri", "to", "mu"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["eau", "ion", "que", "ré"]}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ",", "."]) for _ in range(n))


def test_posteriors_match_all_paths():
    rng = np.random.default_rng(3)
    k, sizes = 3, [1, 2, 5, 7, 4]
    starts = np.cumsum([0, *sizes])[:-1]
    scores, transition = rng.normal(size=(sum(sizes), k)) * 2, rng.normal(size=(k, k))
    want = []
    for s, n in zip(starts, sizes):
        total = np.zeros((n, k))
        for path in product(range(k), repeat=n):
            value = sum(scores[s + i, y] for i, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:]))
            for i, y in enumerate(path):
                total[i, y] += np.exp(value)
        want.append(total / total.sum(axis=1, keepdims=True))
    for block in (1, 2, 3, 32):
        assert np.allclose(language.posteriors(scores, starts, transition, block), np.vstack(want), atol=1e-9)


def test_pair_expectation_matches_all_paths():
    rng = np.random.default_rng(8)
    scores, transition, k, n = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), 3, 4
    joint, whole = np.zeros((k, k)), 0.0
    for path in product(range(k), repeat=n):
        value = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:])))
        whole += value
        for a, b in zip(path, path[1:]):
            joint[a, b] += value
    found, pairs = language.forward_backward(scores, np.array([0]), transition)
    assert np.allclose(pairs, joint / whole, atol=1e-9)
    assert np.allclose(found, language.posteriors(scores, np.array([0]), transition), atol=1e-9)


def test_blocks_and_words_agree():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 200, 40)
    starts = np.cumsum([0, *sizes])[:-1]
    scores, transition = rng.normal(size=(int(sizes.sum()), 5)) * 3, rng.normal(size=(5, 5))
    found, pairs = language.forward_backward(scores, starts, transition)
    assert np.allclose(found, language.posteriors(scores, starts, transition), atol=1e-9)
    assert np.isclose(pairs.sum(), len(scores) - len(sizes))


def test_long_words_are_read_whole():
    rng = random.Random(2)
    words = ["ab", "x" * 50, "".join(rng.choice("一二三四五六") for _ in range(2_000)), "", "é" * 7]
    who, what = language.features(words)
    for k, word in enumerate(words):
        want = np.bincount(what[who == k], minlength=language.BUCKETS)
        for piece in (3, 64, 1 << 18):
            assert (language.long_word(word, piece) == want).all()
    weights = np.random.default_rng(1).normal(size=(language.BUCKETS, 3))
    assert np.allclose(language.state_scores(words, weights, 16), language.state_scores(words, weights), atol=1e-6)
    other = words[2][:700] + words[2][700:1400][::-1] + words[2][1400:]
    assert not np.allclose(*language.state_scores([words[2], other], weights))


def test_many_languages():
    """More languages than blocks are used for, one of them without spaces."""
    rng = random.Random(4)
    names = [f"l{k:02d}" for k in range(30)]
    sounds = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(6)] for n in names}
    sounds["l07"] = list("漢字仮名交文章")

    def said(name, n):
        words = ["".join(rng.choice(sounds[name]) for _ in range(3)) for _ in range(n)]
        return ["".join(words)] if name == "l07" else words

    model = language.train([(said(n, 40), k) for k, n in enumerate(names) for _ in range(6)], names)
    texts = [" ".join(said(n, 30)) for n in names]
    assert sum(a == b for a, b in zip(model.predict(pa.array(texts))[0], names)) >= 29
    assert model.predict(pa.array([said("l07", 100_000)[0]]))[0] == ["l07"]


def test_sample_is_cut_before_the_shuffle(spark):
    rng = random.Random(6)
    rows = [(" ".join(text_of(rng, name, 30).split()), name) for name in SYLLABLES for _ in range(30)]
    rows += [("漢字仮名" * 5_000, "dd"), ("\u0301 \u0302", "dd"), (None, "dd"), ("text", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(df, sample_docs=20, sample_words=50)
    assert model.languages == ["aa", "bb", "cc", "dd"]
    assert model.predict(pa.array(["karito mukari", "名字漢仮" * 50]))[0] == ["aa", "dd"]


def field():
    rng = random.Random(1)
    rows = [([w.strip(",.") for w in text_of(rng, name, 80).split()], k) for k, name in enumerate(SYLLABLES) for _ in range(25)]
    return language.train(rows, list(SYLLABLES))


def test_words_of_switched_text(spark):
    rng = random.Random(5)
    parts = [(name, text_of(rng, name, 12)) for name in ("aa", "bb", "aa", "cc", "bb")]
    text = " ".join(t for _, t in parts) + " 123 --"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = sorted((r["place"], r["lang"]) for r in language.label_words(df, field()).collect())
    truth = [name for name, t in parts for _ in t.split()]
    right = sum(lang == truth[place] for place, lang in rows)
    assert len(rows) == len(truth) and right >= 0.95 * len(truth)


def test_odd_texts():
    model = field()
    texts = [None, "", "  \n", "123 -- !", "karito", "ka " * 40_000, "x" * 100_000, "eauion que \x00 schung", "KARITO RI MU"]
    names, score = model.predict(pa.array(texts, pa.string()))
    assert names[:4] == ["und"] * 4 and names[4] == names[5] == names[8] == "aa"
    assert (score[:4] == 0).all() and ((score >= 0) & (score <= 1)).all()
    assert model.predict(pa.array([], pa.string()))[0] == []
    assert model.predict(pa.array(["\u0301\u0302 \u0301"]))[0] == ["und"]


def test_query_held_out_accuracy(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = language.op1_language(spark, sf_dir).collect()
    assert len(rows) == len(docs) and all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)


def test_no_labels_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "karito", None, "x"), (1, "karito", None, "x"), (None, None, "aa", "y")], "doc_id long, text string, lang string, score string")
    none = language.fit(df)
    assert sorted(map(tuple, language.identify(df, none, ["doc_id"]).collect()), key=str) == [(1, "und", 0.0), (1, "und", 0.0), (None, "und", 0.0)]
    assert language.identify(df.limit(0), none, ["doc_id"]).count() == 0
