import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillwork.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{row number: smallest id reachable} by comparing all pairs."""
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    low = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    return prints, [low.get(c) for c in label]


TEXTS = [
    (7, "One two three four five six seven"), (3, "one  two three four\nfive six seven"), (9, None), (4, ""), (5, " \x0b\x1c "),
    (None, "one two three four five six seven"), (11, "É é Ünï ß 漢字 x"), (12, "a"), (12, "A"), (13, "a b"), (14, "word " * 5000), (2, "word " * 4999),
    (20, "x"), (21, " "), (22, "tick tock tick tock tick tock"),
]


def test_fingerprints_and_components_match_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 400)) for _ in range(6)]
    near = []
    for k, text in enumerate(base * 8):
        words = text.split()
        for _ in range(k // 6):
            words[int(rng.integers(0, 400))] = "new"
        near.append((100 + k, " ".join(words)))
    rows = TEXTS + near
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, simhash.near_duplicates(df).select("doc_id", "fp", "component_id").collect()), key=str)
    prints, ids = plain_components(rows)
    want = sorted(((r[0], int(np.uint64(p).view(np.int64)), c) for r, p, c in zip(rows, prints, ids)), key=str)
    assert got == want


@pytest.mark.parametrize("block", [3, 4096])
def test_links_connect_what_all_pairs_connect(spark, block):
    rng = np.random.default_rng(1)
    seeds = rng.integers(-(2**63), 2**63 - 1, 12)
    fps = {int(s) ^ (1 << int(b)) if b < 63 else int(s) for s in seeds for b in rng.integers(0, 64, 12)}
    fps |= {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 200)}
    distinct = spark.createDataFrame([(x, 0) for x in fps], "fp long, low long")
    links = {(r["a"], r["b"]) for r in simhash.near_links(distinct, 2, block).collect()}
    order = sorted(fps)
    mask = (1 << 64) - 1
    near = {(a, b) for a in order for b in order if a < b and ((a ^ b) & mask).bit_count() <= 2}

    def components(pairs):
        label = {x: x for x in order}
        for _ in order:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert components(links) == components(near)


def test_keep_one(spark):
    text = "one two three four five six seven"
    rows = [(5, text, "b", 1), (2, text, "a", 1), (2, text, "a", 1), (8, "other words stay here always", "a", 2), (None, text, "n", 3),
            (2, "a third text that no other row has", "z", 4), (9, "a third text that no other row has", "z", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component long")
    kept = sorted(map(tuple, simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([rows[1], rows[3], rows[5]], key=str)
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_one_of_each_component_stays(spark):
    text, other = " ".join(f"w{k}" for k in range(200)), " ".join(f"v{k}" for k in range(200))
    rows = [(None, other, "a")] * 6 + [(None, text, "b"), (5, text, "c"), (5, text, "c"), (5, text, "d"), (9, text, "e"), (7, None, "f"), (8, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _kept string")
    df = df.withColumns({"_print": F.lit(1), "fp": F.lit(2), "row": F.lit("r"), "component": F.create_map(F.lit("k"), F.col("_kept"))})
    kept = simhash.keep_one(df.repartition(3))
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["_kept"], r["component"]["k"], r["fp"]) for r in kept.collect() if r["doc_id"] is not None) == [(5, "c", "c", 2), (7, "f", "f", 2)]
    assert [r["_kept"] for r in kept.where("doc_id IS NULL").collect()] == ["a"]
    assert simhash.keep_one(df.limit(0)).count() == 0
