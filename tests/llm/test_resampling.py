import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.llm import resampling as rs


def features(text, buckets):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % buckets for r in runs]


def brute(rows, items, share=(5, 100), least=20, buckets=10_000, seed=42):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text, buckets)[1])
    for text in items:
        t.update(features(text, buckets)[1])
    all_s, all_t = s.total(), t.total()

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    out = []
    for doc_id, text in rows:
        words, found = features(text, buckets)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: share[0] * len(able) // share[1]]
    ranks = {}
    for k, r in enumerate(drawn):
        ranks.setdefault(r, []).append(k + 1)
    return sorted((*r, ranks[r].pop(0) if ranks.get(r) else None) for r in out) if all(r[0] is not None for r in out) else sorted(
        ((*r, ranks[r].pop(0) if ranks.get(r) else None) for r in out), key=str)


WORDS = ["alpha", "Beta", "GAMMA", "dé", "漢字", "x1", "İ", "o'n", "a_b", "zz"]


def some_rows(count=300, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(k, " ".join(WORDS[x] for x in rng.integers(0, len(WORDS), rng.integers(1, 60)))) for k in range(count)]
    same = "the same words again " * 8
    rows += [(1000, same)] * 90 + [(None, same)] * 70 + [(None, None), (1001, ""), (1002, " \n-"), (1003, None), (5, "long " * 3000)]
    return rows


ITEMS = ["beta gamma x1 x1 zz", "the same", None, ""]


def frames(spark, rows, items=ITEMS):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit("clash"), "score": F.lit(1), "row": F.lit(2)})
    return docs.repartition(5), spark.createDataFrame([(i,) for i in items], "text string")


@pytest.mark.parametrize("segment_rows,samples", [(1 << 16, 1 << 20), (20, 1 << 20), (7, 30)])
def test_against_brute_force(spark, monkeypatch, segment_rows, samples):
    monkeypatch.setattr(rs, "SEGMENT_ROWS", segment_rows)
    monkeypatch.setattr(rs, "SAMPLES", samples)
    rows = some_rows()
    docs, target = frames(spark, rows)
    gains = rs.bucket_gains(rs.bucket_counts(target), rs.bucket_counts(docs))
    scored = rs.importance_scores(docs, gains)
    for share in ((5, 100), (70, 100), (1, 1)):
        got = sorted(map(tuple, rs.ranked(scored, share, segment_rows=segment_rows).collect()), key=str)
        assert got == sorted(brute(rows, ITEMS, share), key=str)


def test_defined_results_of_empty_inputs(spark):
    docs, target = frames(spark, [(1, "a b c"), (None, None)])
    assert sorted(map(tuple, rs.importance_ranks(docs, target).collect()), key=str) == brute([(1, "a b c"), (None, None)], ITEMS)
    assert rs.importance_ranks(docs.limit(0), target).collect() == []
    rows = some_rows(60)
    docs, none = frames(spark, rows, [])
    assert sorted(map(tuple, rs.importance_ranks(docs, none).collect()), key=str) == sorted(brute(rows, []), key=str)


def test_pieces_give_the_features_of_the_whole_text():
    text = " ".join(WORDS[k % 10] * (1 + k % 3) for k in range(200))
    words, whole = features(text, 10_000)
    for piece in (1, 7, 50, 10_000):
        found = list(rs.bucket_pieces(text.encode(), piece=piece))
        assert sum(n for n, _ in found) == words
        assert sorted(np.concatenate([b for _, b in found]).tolist()) == sorted(whole)


def test_drawn_documents_come_whole(spark):
    rows = some_rows()
    docs, target = frames(spark, rows)
    drawn = {r[0] for r in brute(rows, ITEMS, (20, 100)) if r[5] is not None and r[0] is not None}
    kept = rs.resample(docs, target, share=(20, 100))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted(r for r in rows if r[0] in drawn)
