from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillwork.schemas import EXAMPLE, RAW_TEXTS, require
from quillwork.session import materialise, new_folder
from quillwork.sources.corpora import raw_texts, read_known_corpora, read_text_corpus, rejected_texts, short_texts
from quillwork.sources.tables import read_csv_sources
from quillwork.sources.versions import VersionedTables, version_name
from quillwork.fixed import CORPORA
from quillwork.plans.gather import gather_texts


def test_short_texts_limit_is_strict(spark):
    rows = [(" ".join(["w"] * n),) for n in (1, 149, 150, 151)]
    frame = spark.createDataFrame(rows, "t string")
    raw = raw_texts(frame, "t", F.lit("s"), F.lit("train"), F.lit("c"))
    assert sorted(r["original_length"] for r in short_texts(raw).collect()) == [1, 149]


def test_null_texts_are_rejected_and_counted(spark):
    frame = spark.createDataFrame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    raw = raw_texts(frame, ["x", "y"], F.lit("s"), F.lit("train"), F.lit("c"))
    assert [r["original_text"] for r in raw.collect()] == ["a\nb"]
    assert rejected_texts(frame, ["x", "y"]).first()["rejected"] == 2


def test_known_corpora_are_read_by_split(spark, tmp_path):
    for corpus, _, keys, splits in CORPORA:
        for split in splits:
            frame = spark.createDataFrame([tuple(f"{corpus} {k}" for k in keys)], ", ".join(f"{k} string" for k in keys))
            frame.withColumn("extra", F.lit(1)).write.json(f"{tmp_path}/{corpus}/{split}")
    corpora = read_known_corpora(spark, str(tmp_path), "json")
    rows = gather_texts(corpora).collect()
    assert len(rows) == sum(len(splits) for *_, splits in CORPORA) == 15
    cloze = next(r for r in rows if r["corpus"] == "story_cloze-2016")
    assert cloze["original_text"].count("\n") == 3 and cloze["split"] == "test"
    assert cloze["source"] == "gimmaru/story_cloze-2016"


def test_data_files_and_missing_split(spark, tmp_path):
    spark.createDataFrame([("x",)], "t string").write.parquet(f"{tmp_path}/a")
    read = read_text_corpus(spark, "name", "t", data_files={"train": f"{tmp_path}/a"}, subset="ignored")
    assert read.first()["source"] == "name"
    with pytest.raises(ValueError):
        read_text_corpus(spark, "name", "t", splits=["test"], data_files={"train": f"{tmp_path}/a"})


def test_csv_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "id,original_text,rewritten_text,rewrite_prompt\n"
        '1,"two\nlines","say ""hi"", you",p1\n'
        "2,NA,r,p\n3,o,,p\n4,o,null,p\n5,o,r,p2\n",
        encoding="utf-8",
    )
    (tmp_path / "b.csv").write_text("rewrite_prompt,original_text,rewritten_text\np3,o3,r3\n", encoding="utf-8")
    rows = read_csv_sources(spark, [("first", str(tmp_path), ["a.csv", "b.csv", "b.csv"]), ("second", str(tmp_path), ["b.csv"])])
    got = Counter(tuple(r) for r in rows.collect())
    assert rows.columns == ["original_text", "rewritten_text", "rewrite_prompt", "source"]
    assert got == {
        ("two\nlines", 'say "hi", you', "p1", "first"): 1,
        ("o", "r", "p2", "first"): 1,
        ("o3", "r3", "p3", "first"): 2,
        ("o3", "r3", "p3", "second"): 1,
    }


@pytest.fixture
def tables(spark):
    return VersionedTables(spark, new_folder(spark, "tables"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "original_text string, rewritten_text string, rewrite_prompt string, split string")


def test_versions_round_trip(spark, tables):
    first = frame(spark, [("a", "b", "c", "train"), ("d", "e", "f", "test")])
    assert tables.write(first, "kind", 1) == 0
    with pytest.raises(FileExistsError):
        tables.write(first, "kind", 1)
    assert tables.write(frame(spark, [("A", "B", "C", "train")]), "kind", 1, revise=True) == 1
    tables.write(first.withColumn("more", F.lit(1)), "kind", "downloaded")
    tables.write(first.drop("rewrite_prompt"), "kind", 10)
    assert tables.versions("kind") == ["v-1", "v-10", "v-downloaded"]
    assert tables.latest("kind", 1) == 1
    newest = tables.read("kind", 1, EXAMPLE)
    assert [tuple(r) for r in newest.collect()] == [("A", "B", "C", "v-1", 1, "train")]
    everything = Counter((r["version"], r["split"], r["rewrite_prompt"]) for r in tables.read_all("kind", EXAMPLE).collect())
    assert everything == {
        ("v-1", "train", "C"): 1,
        ("v-downloaded", "train", "c"): 1, ("v-downloaded", "test", "f"): 1,
        ("v-10", "train", None): 1, ("v-10", "test", None): 1,
    }


def test_split_filter_prunes_folders(spark, tables):
    tables.write(frame(spark, [("a", "b", "c", "train"), ("d", "e", "f", "test")]), "kind", 1)
    plan = tables.read_all("kind", EXAMPLE).where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_uncommitted_revision_is_not_read(spark, tables):
    import os

    tables.write(frame(spark, [("a", "b", "c", "train")]), "kind", 1)
    tables.write(frame(spark, [("x", "y", "z", "train")]), "kind", 1, revise=True)
    os.remove(f"{tables.root}/kind/version=v-1/revision=1/_SUCCESS")
    assert tables.read("kind", 1, EXAMPLE).first()["original_text"] == "a"
    assert tables.write(frame(spark, [("n", "n", "n", "train")]), "kind", 1, revise=True) == 2
    assert tables.read("kind", 1, EXAMPLE).first()["original_text"] == "n"


def test_missing_versions(spark, tables):
    assert tables.read_all("nothing", EXAMPLE).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read("nothing", 1, EXAMPLE)
    with pytest.raises(ValueError):
        version_name("v-new")


def test_require_names_the_wrong_columns(spark):
    with pytest.raises(ValueError, match="original_length"):
        require(spark.createDataFrame([("a",)], "original_text string"), RAW_TEXTS, "stage")


def test_materialise_keeps_rows_and_cuts_the_plan(spark):
    made = materialise(spark.range(100).withColumn("x", F.col("id") * 2))
    assert made.count() == 100
    assert "Range" not in made._jdf.queryExecution().optimizedPlan().toString()
