import sys

import pytest
from pyspark.sql import functions as F

from quillwork.functions import text as T
from quillwork.fixed import WHITESPACE


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize("body", ["", "a  b ", "a\nb c", " ", "one", "é ü  x", "tab\tno"])
def test_word_count_cuts_at_single_spaces(spark, body):
    assert values(spark, [(body,)], "t string", T.word_count("t")) == [(len(body.split(" ")),)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5])
def test_fewer_words_is_the_strict_count(spark, n):
    bodies = ["", " ", "a", "a b", "a  b", "a b c", "a\nb c d", "é é é é"]
    got = values(spark, [(b,) for b in bodies], "t string", T.fewer_words("t", n))
    assert got == [(len(b.split(" ")) < n,) for b in bodies]


def test_whitespace_is_what_unicode_strip_removes():
    assert set(WHITESPACE) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


@pytest.mark.parametrize("body", ["  x y  \n", "", " \t ", "x", "\x1cx\x85"])
def test_strip(spark, body):
    assert values(spark, [(body,)], "t string", T.strip("t")) == [(body.strip(),)]


@pytest.mark.parametrize("body", ["one line", "first\nsecond\nthird", "only\n", "\nx", ""])
def test_drop_first_line(spark, body):
    want = "\n".join(body.split("\n")[1:]) if "\n" in body else body
    assert values(spark, [(body,)], "t string", T.drop_first_line("t")) == [(want,)]


@pytest.mark.parametrize("body", ["a[/INST]b[/INST] c ", "no marker", "[/INST]", "x[/INST]"])
def test_after_last_is_literal(spark, body):
    assert values(spark, [(body,)], "t string", T.after_last("t", "[/INST]")) == [(body.split("[/INST]")[-1],)]


def test_up_to_last(spark):
    rows = [("a[/INST]b[/INST] c",), ("none",), ("é[/INST]",)]
    assert values(spark, rows, "t string", T.up_to_last("t", "[/INST]")) == [
        ("a[/INST]b[/INST]",), ("none",), ("é[/INST]",)
    ]


def test_fill_does_not_expand_field_values(spark):
    rows = [("holds {b} and {a}", "B {a}")]
    assert values(spark, rows, "a string, b string", T.fill("x {a} y {b} z", a="a", b="b")) == [
        ("x holds {b} and {a} y B {a} z",)
    ]


def test_fill_one_of_takes_one_template(spark):
    rows = [(0, "q"), (1, "q"), (2, "q")]
    chosen = T.fill_one_of(["0 {a}", "{a} 1", "2"], F.col("i"), a="a")
    assert values(spark, rows, "i int, a string", chosen) == [("0 q",), ("q 1",), ("2",)]


def test_join_texts_rejects_null_parts(spark):
    rows = [("a", "b"), ("a", None)]
    assert values(spark, rows, "a string, b string", T.join_texts("a", "b")) == [("a\nb",), (None,)]


def test_remove_echo(spark):
    rows = [("in out in", "in"), ("out", "")]
    assert values(spark, rows, "g string, i string", T.remove_echo("g", "i")) == [(" out ",), ("out",)]


def test_token_containment(spark):
    rows = [("Add a Twist", "twist and a turn"), ("x", "y"), ("a a", "A"), ("p", None)]
    got = values(spark, rows, "p string, t string", T.token_containment("p", "t"))
    assert got == [(2 / 3,), (0.0,), (1.0,), (None,)]
