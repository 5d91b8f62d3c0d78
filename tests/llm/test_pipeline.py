import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from pyspark.sql import functions as F
from test_decontamination import brute
from test_personal_data import plain
from test_simhash import plain_components

from quillwork.llm import toxicity
from quillwork.llm.common import table


def test_stages_against_plain_versions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    kept = stages["toxicity"](spark, docs, sf_dir)
    model = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    rows = docs.collect()
    want = {r["doc_id"] for r, s in zip(rows, model.score([r["text"] for r in rows])) if s < 0.7}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == want

    near = stages["near_duplicates"](spark, docs, sf_dir)
    _, ids = plain_components([(r["doc_id"], r["text"]) for r in rows])
    assert near.columns == columns and sorted(r["doc_id"] for r in near.collect()) == sorted(set(ids))

    some = docs.where("n_chars < 1500")
    clean = stages["decontamination"](spark, some, sf_dir)
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    hits = {r[0]: r[2] for r in brute([(r["doc_id"], r["text"]) for r in some.collect()], items)}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == {i for i, n in hits.items() if n == 0}

    private = stages["personal_data"](spark, docs, sf_dir)
    assert private.columns == columns
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in private.collect():
        assert r["n_chars"] == len(r["text"]) and not plain(r["text"])
        assert plain(texts[r["doc_id"]]) or r["text"] == texts[r["doc_id"]]


def test_odd_rows_pass_all_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, "", "en", None, 0), (10**6, "", "en", None, 0), (None, "a b c", None, "s", 5),
         (10**6 + 1, "z " * 40_000, "xx", "s", None)],
        docs.schema,
    )
    for source in (docs.unionByName(odd), docs.limit(0)):
        kept = source.withColumn("toxic", F.lit("clash")).withColumn("size", F.lit(1))
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, sf_dir)
        counts = Counter(r["doc_id"] for r in kept.collect())
        assert all(n <= 2 for i, n in counts.items() if i is not None)


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    taken = Counter(r["doc_id"] for r in rows)
    assert rows and max(taken.values()) <= 2 and {"doc_id", "text", "lang", "source", "n_chars", "copy"} == set(rows[0].asDict())
