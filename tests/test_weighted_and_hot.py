"""Weighted draws, keys that are hot on both sides, repeated keys, commits of two writers, counts of a pass."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.operators import ranking, weighted
from quillwork.operators.joins import SizeBound, salted_join
from quillwork.schemas import EXAMPLE
from quillwork.session import materialise, new_folder
from quillwork.sources.corpora import read_text_corpus, seen_counts
from quillwork.sources.versions import VersionedTables


def bag(frame):
    return Counter(tuple(r) for r in frame.collect())


def chances(table, whole, n):
    """What each item is drawn with, in units of 1 / (whole * n)."""
    out = Counter()
    for place, share, alias in table:
        out[place] += int(share)
        out[alias] += whole - int(share)
    return [out[k] for k in range(n)]


@pytest.mark.parametrize("weights", [
    [1], [5, 5, 5, 5], [1, 2, 3, 4, 5, 6, 7], [0, 0, 7, 0], [1000, 1, 1, 1, 1, 1, 1], [3, 1, 3, 1, 3, 1, 2], [2**30] + [0] * 30 + [1] * 30,
    np.random.default_rng(1).integers(0, 1000, 500).tolist(), (np.random.default_rng(2).pareto(1, 300) * 100).astype(int).tolist(),
])
def test_alias_table_has_exactly_the_weights(spark, monkeypatch, weights):
    monkeypatch.setattr(weighted, "CHUNK", 16)
    items = spark.createDataFrame(list(enumerate(map(int, weights))), "place long, weight long").repartition(5)
    table, whole = weighted.alias_table(items)
    rows = [tuple(r) for r in table.select("place", "share", "alias").collect()]
    assert whole == sum(weights) and sorted(r[0] for r in rows) == list(range(len(weights)))
    assert all(0 <= share <= whole and 0 <= alias < len(weights) for _, share, alias in rows)
    assert chances(rows, whole, len(weights)) == [w * len(weights) for w in weights]


@pytest.mark.parametrize("weights", [[0, 0], [1, -1], [1, None]])
def test_weights_that_cannot_be_drawn_by(spark, weights):
    with pytest.raises(ValueError):
        weighted.alias_table(spark.createDataFrame(list(enumerate(weights)), "place long, weight long"))


def test_weighted_draws_follow_the_weights(spark):
    shares = [0.5, 3.0, 0.0, 1.5, 10.0, 1.0]
    pool = weighted.weighted_pool(spark.createDataFrame([(f"p{k}", w) for k, w in enumerate(shares)], "name string, weight double"), "weight", ["name"])
    texts = spark.range(5000).withColumn("name", F.lit("mine")).unionByName(spark.createDataFrame([(None, "n")], "id long, name string"))
    drawn = weighted.draw_weighted(texts, pool, ["id"], {"name": "drawn"}, k=4)
    assert drawn.columns == ["id", "name", "draw_no", "drawn"]
    small = bag(drawn)
    assert small == bag(weighted.draw_weighted(texts, pool, ["id"], {"name": "drawn"}, k=4, bound=SizeBound(0, 0)))
    assert len(small) == 4 * 5001 and set(small.values()) == {1}
    counts = Counter(r[3] for r in small)
    wanted = {f"p{k}": 20004 * w / sum(shares) for k, w in enumerate(shares)}
    assert counts["p2"] == 0
    assert sum((counts[p] - n) ** 2 / n for p, n in wanted.items() if n) < 20.5  # 0.1 % of chi-square with 4 degrees of freedom lies beyond 18.5
    assert weighted.draw_weighted(texts, pool, ["id"], {"name": "name"}, k=1).columns == ["id", "draw_no", "name"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_sides_of_a_hot_key_are_split(spark, how):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"))
    lookup = spark.range(600).select(F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 30)).alias("k"), F.col("id").alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([("hot", 7), (None, 1), ("absent", 2)], "k string, v long"))
    joined = salted_join(big, lookup, ["k"], ["id"], how)
    assert joined.columns == ["k", "id", "v"]
    assert bag(joined) == bag(big.join(lookup, ["k"], how).select("k", "id", "v"))


def test_no_task_holds_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(20_000).select("id", F.when(F.col("id") < 19_000, "hot").otherwise(F.col("id").cast("string")).alias("k"))
        lookup = spark.range(400).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        pairs = salted_join(big, lookup, ["k"], ["id"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    counts = [r["count"] for r in pairs]
    assert sum(counts) == 19_000 * 400 and max(counts) <= 0.25 * sum(counts) and len(counts) > 16


def test_a_repeated_key_is_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CROWD", 50)
    monkeypatch.setattr(ranking, "PIECE", 64)
    rows = [("a", "same")] * 700 + [("b", "same")] * 60 + [(g, f"x{k}") for g in "ab" for k in range(300)] + [(None, "same")] * 90 + [("a", None)] * 80
    frame = spark.createDataFrame(rows, "g string, k string")
    found = [ranking.with_group_index(frame.repartition(n), ["g"], ["k"], digits=2).collect() for n in (2, 7)]
    assert Counter(map(tuple, found[0])) == Counter(map(tuple, found[1]))
    for g in ("a", "b", None):
        assert sorted(r["id"] for r in found[0] if r["g"] == g) == list(range(sum(x == g for x, _ in rows)))
        places = sorted(r["id"] for r in found[0] if r["g"] == g and r["k"] == "same")
        assert places == list(range(places[0], places[0] + len(places)))
    monkeypatch.setattr(ranking, "CROWD", 1_000_000)
    assert Counter(map(tuple, ranking.with_group_index(frame, ["g"], ["k"], digits=2).collect())) == Counter(map(tuple, found[0]))


def test_samples_of_one_repeated_key(spark):
    frame = spark.range(4000).select(F.lit("same").alias("k"), F.lit("train").alias("split"))
    assert ranking.sample_per_split(frame, 30, ["k"]).count() == 30


def test_two_writers_at_once(spark):
    root = new_folder(spark, "writers")
    first, second = VersionedTables(spark, root), VersionedTables(spark, root)
    rows = spark.createDataFrame([("a", "b", "c", "train"), ("d", "e", "f", "test")], "original_text string, rewritten_text string, rewrite_prompt string, split string")
    # the first has looked and claimed, and has not written yet
    assert first._claim("kind", "v-1", 0)
    with pytest.raises(FileExistsError):
        second.write(rows, "kind", 1)
    assert not second._claim("kind", "v-1", 0)
    with pytest.raises(FileNotFoundError):
        second.read("kind", 1, EXAMPLE)
    # one that asks for a revision takes the next number, and both are whole
    assert second.write(rows, "kind", 1, revise=True) == 1 and first.write(rows.limit(1), "kind", 1, revise=True) == 2
    assert second.read("kind", 1, EXAMPLE).count() == 1

    class Late(VersionedTables):
        """Looks for revisions before another writer claims one."""

        def _claim(self, kind, version, revision):
            second.written.clear()
            assert second._children(f"{root}/{kind}/version={version}", "revision") == []
            VersionedTables._claim(second, kind, version, revision)
            return super()._claim(kind, version, revision)

    with pytest.raises(FileExistsError):
        Late(spark, root).write(rows, "other", 1)


def test_counts_come_with_the_write(spark, tmp_path):
    tables = VersionedTables(spark, new_folder(spark, "counts"))
    rows = spark.createDataFrame([("a", "train"), ("b", "train"), ("c", "odd")], "t string, split string")
    tables.write(rows, "kind", 3)
    assert sorted(map(tuple, tables.counts("kind").collect())) == [("v-3", 0, "train", 2)]
    assert tables.written["kind", "v-3", 0]["rows"] == 3
    for split, texts in {"train": ["one two", None, "a b c d e", None], "test": ["x"]}.items():
        spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(f"{tmp_path}/{split}")
    seen = {}
    corpus = read_text_corpus(spark, "name", "text", path=str(tmp_path), splits=["train", "test"], max_words=4, seen=seen)
    assert materialise(corpus).count() == 2
    assert sorted(map(tuple, seen_counts(spark, seen).collect())) == [("name", "test", 1, 0, 0), ("name", "train", 4, 2, 1)]
