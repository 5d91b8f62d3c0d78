import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillwork.operators import labeling as L
from quillwork.operators.generation import attach_generations, generate_texts, non_empty, stamp
from quillwork.operators.sampling import bypassed
from quillwork.operators.scorers import FunctionScorer, with_scores


def test_thresholds_are_strict(spark):
    scored = spark.createDataFrame([(0.95,), (0.951,), (None,)], "en double")
    assert [r["en"] for r in L.english_only(scored).collect()] == [0.951]
    polluted = spark.createDataFrame([(0.5,), (0.499,)], "yes double")
    assert [r["yes"] for r in L.unpolluted(polluted).collect()] == [0.499]


def test_topics_sum_to_one_and_first_wins_a_tie(spark):
    rows = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 3.0), (3, 800.0, -800.0)], "id int, a double, b double")
    got = L.with_topic_label(rows, {"x": F.col("a"), "y": F.col("b")}).orderBy("id").collect()
    assert [r["most_likely_label"] for r in got] == ["y", "x", "x"]
    assert all(abs(r["x"] + r["y"] - 1) < 1e-12 for r in got)
    again = L.with_most_likely(spark.createDataFrame([(0.2, 0.2, 0.1)], "x double, y double, z double"), ["x", "y", "z"])
    assert again.first()["most_likely_label"] == "x"


def test_allowed_topics_drop_marketing(spark):
    rows = spark.createDataFrame([("marketing",), ("tweet",), ("story",)], "most_likely_label string")
    assert L.allowed_topics(rows).count() == 2


PAIRS = [
    # key, prompt, text, score of text, score of text without its first line
    (1, "p", "polluted\nclean", 0.9, 0.1),
    (2, "p", "at the limit\nclean", 0.7, 0.1),
    (3, "p", "no better\nno better", 0.9, 0.9),
    (4, "p", "single polluted line", 0.9, 0.9),
    (5, "p", "fine\nfine", 0.2, 0.1),
    (6, "p", "trailing\n", 0.8, 0.0),
]


def lookup_scorer(prompt, text):
    """Scores the whole texts and the shortened ones by a table."""
    column = F.lit(None).cast("double")
    for _, _, body, whole, shorter in PAIRS:
        column = F.when(text == body, F.lit(whole)).otherwise(column)
    for _, _, body, whole, shorter in PAIRS:
        if "\n" in body:
            column = F.when(column.isNull() & (text == body.split("\n", 1)[1]), F.lit(shorter)).otherwise(column)
    return column


def test_repair_rules(spark):
    frame = spark.createDataFrame([p[:3] for p in PAIRS], "id int, rewrite_prompt string, rewritten_text string")
    got = {r["id"]: r for r in L.label_pollution(frame, ["id"], lookup_scorer, skip_prob=0.0).collect()}
    assert (got[1]["rewritten_text"], got[1]["yes"]) == ("clean", 0.1)
    assert (got[2]["rewritten_text"], got[2]["yes"]) == ("at the limit\nclean", 0.7)
    assert (got[3]["rewritten_text"], got[3]["yes"]) == ("no better\nno better", 0.9)
    assert (got[4]["rewritten_text"], got[4]["yes"]) == ("single polluted line", 0.9)
    assert (got[5]["rewritten_text"], got[5]["yes"]) == ("fine\nfine", 0.2)
    assert (got[6]["rewritten_text"], got[6]["yes"]) == ("", 0.0)
    assert all(r["scored"] for r in got.values())


def test_skipped_rows_pass_unscored(spark):
    frame = spark.range(300).select("id", F.lit("a b").alias("rewrite_prompt"), F.lit("a b\nrest").alias("rewritten_text"))
    rows = L.label_pollution(frame, ["id"], skip_prob=0.5, seed=4).collect()
    skipped = {r["id"] for r in frame.where(bypassed(0.5, "id", salt=4)).collect()}
    assert 100 < len(skipped) < 200
    for r in rows:
        if r["id"] in skipped:
            assert (r["yes"], r["rewritten_text"], r["scored"]) == (0.0, "a b\nrest", False)
        else:
            assert (r["yes"], r["rewritten_text"], r["scored"]) == (0.0, "rest", True)


def test_batch_scorer_can_label_pollution(spark):
    def share_of_x(batch: pd.DataFrame) -> pd.DataFrame:
        text = batch["text"]
        return pd.DataFrame({"p": [None if t is None else t.count("x") / max(len(t), 1) for t in text]})

    frame = spark.createDataFrame([(1, "p", "xxx\nxy"), (2, "p", "y")], "id int, rewrite_prompt string, rewritten_text string")
    got = {
        r["id"]: (r["rewritten_text"], r["yes"])
        for r in L.unpolluted(
            L.label_pollution(frame, ["id"], FunctionScorer(share_of_x), 0.0, prob_original=0.6), 0.51
        ).collect()
    }
    assert got == {1: ("xy", 0.5), 2: ("y", 0.0)}


def test_scorer_is_set_up_once_and_gets_small_batches(spark):
    class CountingScorer:
        """Remembers its life cycle in its output."""

        def setup(self):
            self.log = ["setup"]

        def __call__(self, batch):
            self.log.append(len(batch))
            return pd.DataFrame({"seen": [str(self.log)] * len(batch)})

        def cleanup(self):
            self.log = None

    frame = spark.range(10).coalesce(1)
    got = [r["seen"] for r in with_scores(frame, CountingScorer(), {"id": "id"}, "struct<seen: string>", 4).collect()]
    assert got == ["['setup', 4]"] * 4 + ["['setup', 4, 4]"] * 4 + ["['setup', 4, 4, 2]"] * 2


def test_scores_replace_columns_of_the_same_name(spark):
    frame = spark.createDataFrame([(1, "old")], "id int, t string")
    new = with_scores(frame, FunctionScorer(lambda b: pd.DataFrame({"t": b["t"] + " new"})), {"t": "t"}, "struct<t: string>")
    assert new.columns == ["id", "t"] and new.first()["t"] == "old new"


def test_failed_generations_go_and_nulls_stay(spark):
    frame = spark.createDataFrame([("EMPTY",), (None,), ("x",)], "rewritten_text string")
    assert {r[0] for r in non_empty(frame).collect()} == {None, "x"}


def test_stamp_leaves_out_excluded_parameters(spark):
    frame = stamp(spark.range(1), "m", {"top_k": 40, "num_return_sequences": 4}, excluded=("num_return_sequences",))
    assert frame.columns == ["id", "model", "top_k"]


def test_generate_strips_the_echo(spark):
    frame = spark.createDataFrame([(1, "ask"), (2, "fail")], "id int, input string")

    def answer(batch):
        return pd.DataFrame({"rewritten_text": ["EMPTY" if t == "fail" else t + " yes" for t in batch["input"]]})

    rows = generate_texts(frame, FunctionScorer(answer), "m", {"k": 1}, echoes=True).collect()
    assert [(r["id"], r["rewritten_text"], r["model"], r["k"]) for r in rows] == [(1, " yes", "m", 1)]


def test_attach_generations_by_key(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, input string")
    done = spark.createDataFrame([(2, "B"), (1, "EMPTY")], "id int, rewritten_text string")
    assert {r["id"]: r["rewritten_text"] for r in attach_generations(frame, done, ["id"], "m", {}).collect()} == {2: "B", 3: None}


@pytest.mark.parametrize("language", ["en", "fr"])
def test_language_model_tells_languages_apart(spark, sf_dir, language):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("text", "original_text")
    train = documents.where(F.col("doc_id") % 2 == 0)
    held_out = documents.where(F.col("doc_id") % 2 == 1)
    model = L.train_language_model(train)
    scored = L.with_language_probability(held_out, model, language=language, out_col="p").collect()
    right = sum((r["p"] > 0.5) == (r["lang"] == language) for r in scored)
    assert right / len(scored) > 0.9


def test_batch_scorer_reads_the_question(spark):
    def asked(batch):
        right = batch["text"].isna() | batch["text"].str.startswith("Does the following text contain the information ")
        return pd.DataFrame({"p": right.map({True: 0.25, False: 1.0}).where(batch["text"].notna())})

    frame = spark.createDataFrame([(1, "be brief", "a\nb"), (2, None, "c")], "id long, rewrite_prompt string, rewritten_text string")
    got = L.label_pollution(frame, ["id"], FunctionScorer(asked), 0.0, ask=True).collect()
    assert [(r["yes"], r["rewritten_text"]) for r in sorted(got, key=lambda r: r["id"])] == [(0.25, "a\nb"), (0.25, "c")]
