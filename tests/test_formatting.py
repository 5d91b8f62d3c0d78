import pytest
from pyspark.sql import functions as F

from quillwork import fixed as X
from quillwork.functions.chat import STYLES, render
from quillwork.operators.formatting import format_rows, formatted, style_of, with_marker

ROW = [(1, " The original {rewritten_text} ", "re<eos>written</s>", "make it better")]
SCHEMA = "id int, original_text string, rewritten_text string, rewrite_prompt string"


def text(spark, style, rows=ROW, **options):
    return spark.createDataFrame(rows, SCHEMA).select(formatted(style, ["id"], **options).alias("x")).first()["x"]


def commands(row=ROW[0]):
    return [
        t.replace("{original_text}", "\0").replace("{rewritten_text}", row[2]).replace("\0", row[1])
        for t in X.QUERY_TEMPLATES
    ]


@pytest.mark.parametrize("index", [0, 1, 2])
def test_base_format(spark, index):
    want = commands()[index] + "\n###Prompt Used: make it better"
    assert text(spark, "base", template_index=index) == want
    assert text(spark, "llama", template_index=index) == want


def test_null_prompt_is_an_empty_answer(spark):
    rows = [(1, "o", "r", None)]
    assert text(spark, "base", rows, template_index=1).endswith("###Prompt Used: ")
    assert text(spark, "mistral-it", rows, template_index=1).endswith(" [/INST]")
    assert text(spark, "gemma-it", rows).endswith("<start_of_turn>model\n<end_of_turn>\n")


def test_single_turn_chats(spark):
    gemma = text(spark, "gemma-it", template_index=1)
    assert gemma == (
        f"<start_of_turn>user\n{commands()[1].strip()}<end_of_turn>\n<start_of_turn>model\nmake it better<end_of_turn>\n"
    ).replace("<eos>", "")
    mistral = text(spark, "mistral-it", template_index=1)
    assert mistral == f"[INST] {commands()[1]} [/INST]make it better".replace("</s>", "")
    llama = text(spark, "llama-chat", template_index=1)
    options = [
        f"[INST] <<SYS>>\n{s}\n<</SYS>>\n\n{commands()[1]} [/INST] make it better ".replace("</s>", "")
        for s in X.SYSTEM_PROMPTS
    ]
    assert llama in options


EXAMPLES = [("Good day", "\nAhoy", "Talk like a sailor."), ("Night \u2013 falls", "It is\ndark", "Say it plainly")]


def example_array():
    names = ("original_text", "rewritten_text", "rewrite_prompt")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, e)]) for e in EXAMPLES])


def four(original, rewritten, prompt):
    return [
        f"Original Text: {original}", X.REPLY_TO_ORIGINAL, f"Re-written Text: {rewritten}", f"Prompt Used: {prompt}",
    ]


@pytest.mark.parametrize("system", ["mock", "none"])
def test_message_stack_in_three_dialects(spark, system):
    turns = [t for e in EXAMPLES for t in four(*e)] + four(*ROW[0][1:])
    openings = [[s, X.MOCK_SYSTEM_REPLY] for s in X.SYSTEM_PROMPTS] if system == "mock" else [[]]

    def pairs(opening):
        whole = opening + turns
        return list(zip(whole[::2], whole[1::2]))

    want = {
        "gemma-message-stack": [
            "".join(
                f"<start_of_turn>user\n{u.strip()}<end_of_turn>\n<start_of_turn>model\n{a.strip()}<end_of_turn>\n"
                for u, a in pairs(o)
            ).replace("<eos>", "")
            for o in openings
        ],
        "mistral-message-stack": [
            "".join(f"[INST] {u} [/INST]{a}" for u, a in pairs(o)).replace("</s>", "") for o in openings
        ],
        "llama-message-stack": [
            "".join(f"[INST] {u.strip()} [/INST] {a.strip()} " for u, a in pairs(o)).replace("</s>", "") for o in openings
        ],
    }
    for style, texts in want.items():
        assert text(spark, style, examples=example_array(), system=system) in texts


def test_llama_system_turn_is_folded_into_the_first_user_turn(spark):
    got = text(spark, "llama-message-stack", system="system")
    assert got.startswith("[INST] <<SYS>>\nYou are ") and got.count("<<SYS>>") == 1
    assert "<</SYS>>\n\nOriginal Text:" in got


@pytest.mark.parametrize("style", ["gemma-message-stack", "mistral-message-stack"])
def test_dialects_without_system_turn_refuse_it(spark, style):
    with pytest.raises(ValueError):
        text(spark, style, system="system")


def test_unknown_names_are_errors(spark):
    with pytest.raises(ValueError):
        style_of("gpt")
    with pytest.raises(ValueError):
        text(spark, "gemma-message-stack", system="loud")
    with pytest.raises(ValueError):
        render(F.array(), "klingon")


@pytest.mark.parametrize("style", sorted(STYLES))
def test_every_style_holds_its_marker_and_opens_after_it(spark, style):
    frame = spark.createDataFrame(ROW, SCHEMA)
    assert with_marker(format_rows(frame, style, ["id"]), style).count() == 1
    opened = text(spark, style, rewrite_prompt=None, open_answer=True)
    assert opened.endswith(style_of(style).marker)
    assert text(spark, style).startswith(opened)


def test_marker_filter_is_literal(spark):
    frame = spark.createDataFrame([("INST",), ("a[/INST]b",)], "input string")
    assert [r["input"] for r in with_marker(frame, "mistral-it").collect()] == ["a[/INST]b"]


def test_template_is_drawn_once_per_row(spark):
    frame = spark.range(200).select(
        "id", F.lit("o").alias("original_text"), F.lit("r").alias("rewritten_text"),
        F.lit("good").alias("chosen"), F.lit("bad").alias("rejected"),
    )
    rows = frame.select(
        formatted("gemma-it", ["id"], rewrite_prompt="chosen").alias("c"),
        formatted("gemma-it", ["id"], rewrite_prompt="rejected").alias("r"),
    ).collect()
    assert all(r["c"].replace("good", "") == r["r"].replace("bad", "") for r in rows)
    assert len({r["c"] for r in rows}) == 3
