import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillwork.llm import mixing


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(rows, weights=(5, 2, 1), share=1.5, cap=2):
    """{(doc_id, text, source, nth): (size, source size, target, copies)} by filling the sources one by one."""
    sized = [(i, t, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    totals = Counter()
    for _, _, s, n in sized:
        totals[s] += n
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, open_, targets = share * sum(totals.values()), set(order), {}
    while open_:
        level = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * totals[s]}
        for s in full or open_:
            targets[s] = float(cap * totals[s]) if full else level * weight[s]
        budget -= sum(targets[s] for s in full)
        open_ -= full or open_
    seen, out = Counter(), defaultdict(list)
    for i, t, s, n in sized:
        who = md5(f"{'null' if i is None else i}|{'-' if t is None else md5(t)}")
        rate = targets[s] / totals[s] if totals[s] else 0.0
        u = int(md5(f"mix|0|{who}|{seen[who]}")[:13], 16) / 16**13
        out[i, t, s].append((n, totals[s], pytest.approx(targets[s]), int(rate) + (u < rate - int(rate))))
        seen[who] += 1
    return out


ROWS = (
    [(k, "word " * (1 + k % 9), "small") for k in range(40)] + [(7, f"text number {k} of one id", "hot") for k in range(300)]
    + [(None, f"a text without id {k}", "hot") for k in range(200)] + [(9, "equal rows", "hot")] * 120 + [(None, None, "hot"), (3, "", None), (4, None, None)]
    + [(k, "many words here " * 20, "big") for k in range(500, 540)] + [(1, "huge " * 60_000, "zz"), (2, "\x1c \x0b", "blank")]
)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = {"_rate": F.lit(1), "_copies": F.lit("c"), "who": F.lit("w"), "nth": F.lit(5), "size": F.lit(0), "copy": F.lit(9), "c0": F.create_map(F.lit("k"), F.lit("v"))}
    return df.withColumns(clash).repartition(5)


def test_rates_and_copies(spark):
    want = plain(ROWS)
    rates = mixing.mixing_rates(frame(spark, ROWS)).collect()
    got = Counter((r["doc_id"], r["size"], r["source"], r["source_size"], r["copies"]) for r in rates)
    assert got == Counter((i, n, s, total, c) for (i, _, s), found in want.items() for n, total, _, c in found)
    targets = {s: t for (_, _, s), found in want.items() for _, _, t, _ in found}
    assert all(r["target"] == targets[r["source"]] for r in rates)
    taken = Counter()
    for r in rates:
        taken[r["source"]] += r["copies"] * r["size"]
    for source in ("hot", "big"):
        assert 0.9 < taken[source] / next(r["target"] for r in rates if r["source"] == source) < 1.1


def test_mix_keeps_every_column(spark):
    df = frame(spark, ROWS)
    want = Counter()
    for (i, t, s), found in plain(ROWS).items():
        for n, _, _, copies in found:
            want.update((i, t, s, c) for c in range(1, copies + 1))
    mixed = mixing.mix(df)
    assert mixed.columns == [c for c in df.columns if c != "copy"] + ["copy"]
    rows = mixed.collect()
    assert Counter((r["doc_id"], r["text"], r["source"], r["copy"]) for r in rows) == want
    assert {(r["_rate"], r["_copies"], r["who"], r["nth"], r["c0"]["k"]) for r in rows} == {(1, "c", "w", 5, "v")}
    again = mixing.mix(df.repartition(2)).collect()
    assert Counter((r["doc_id"], r["text"], r["copy"]) for r in again) == Counter((r["doc_id"], r["text"], r["copy"]) for r in rows)


def test_empty_tables(spark):
    df = frame(spark, ROWS).limit(0)
    assert mixing.mixing_rates(df).collect() == [] and mixing.mix(df).collect() == []
    blank = frame(spark, [(1, None, "a"), (2, "", None)])
    assert sorted((r["doc_id"], r["target"], r["copies"]) for r in mixing.mixing_rates(blank).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
