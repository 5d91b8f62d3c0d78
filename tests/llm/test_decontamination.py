import hashlib
import random
import re

import pytest

from quillwork.llm import decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    rows = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            t = words(item)
            for k in range(max(1, len(t) - size + 1) if t else 0):
                window = t[k : k + size]
                for p in range(len(w) - len(window) + 1):
                    if w[p : p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        if item_id is not None:
                            found.add(str(item_id))
        rows.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(rows, key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("block_words", [10**6, 25])
def test_matches_brute_force(spark, block_words):
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice("ab cd ef Gh é".split()) for _ in range(rng.randint(1, 25)))) for k in range(8)]
    items += [(3, items[0][1]), (8, None), (9, " .. "), (None, "q r s t u v w x y z q"), (10, "the the the the the the the the the the the"), (2, "lone")]
    docs = []
    for k in range(40):
        text = " ".join(rng.choice("ab cd ef gh é zz".split()) for _ in range(rng.randint(0, 60)))
        item = rng.choice(items)[1] or ""
        docs.append((k, text + rng.choice([" ", ". ", "-"]) + item.upper() + " " + text[: rng.randint(0, 30)]))
    docs += [(40, None), (41, ""), (42, "the " * 3000), (5, docs[5][1]), (None, "Q-r,s t u v w x y z"), (43, "a lone wolf"), (44, "É É")]
    frame, bench = frames(spark, [(*d, "s") for d in docs], items)
    got = decontamination.contamination(frame, bench, block_words=block_words)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=str) == brute(docs, items)


def test_empty_tables_and_filter(spark):
    docs = [(1, "x a b c d e f g h i j y", "s"), (2, "a b c d e f g h i", "s"), (None, "a b c d e f g h i j", "s"), (3, None, "s")]
    frame, bench = frames(spark, docs, [(7, "a b c d e f g h i j")])
    kept = decontamination.without_contaminated(frame, bench)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert decontamination.without_contaminated(frame, bench.limit(0)).count() == 4
    assert decontamination.contamination(frame.limit(0), bench).count() == 0


def test_proximity(spark):
    docs = [(1, "one two x three four", "s"), (2, "one x x x two three four", "s"), (3, "one two three four", "s"), (4, "four three two one", "s")]
    frame, bench = frames(spark, docs, [(1, "one two three four")])
    near = decontamination.phrase_matches(frame, bench, slop=1)
    assert sorted({r["doc_id"] for r in near.collect()}) == [1, 3]
    exact = decontamination.phrase_matches(frame, bench)
    assert [tuple(r) for r in exact.collect()] == [(3, 0, 4, ["1"])]


def test_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in decontamination.op6_decontamination(spark, sf_dir).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            grams.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    sizes = {len(g) for g in grams}
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if (g := tuple(w[p : p + n])) in grams:
                    hit |= set(range(p, p + n))
                    found |= grams[g]
        r = rows[doc_id]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), len(hit), len(found), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
