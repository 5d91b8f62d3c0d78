"""Rows to instruct or chat text in one of eight styles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.fixed import QUERY_TEMPLATES, SYSTEM_PROMPTS
from quillwork.functions.chat import DIALECTS, STYLES, Style, base_text, chat_messages, render, stack_messages
from quillwork.functions.text import up_to_last
from quillwork.operators.sampling import choice


def style_of(name: str) -> Style:
    if name not in STYLES:
        raise ValueError(f"unknown style {name!r}; use one of {', '.join(STYLES)}")
    return STYLES[name]


def formatted(
    style: str,
    key: list[str],
    original_text="original_text",
    rewritten_text="rewritten_text",
    rewrite_prompt="rewrite_prompt",
    examples=None,
    system: str = "none",
    template_index: int | None = None,
    seed=0,
    open_answer: bool = False,
) -> Column:
    """The text of one row in a style.

    Template and system prompt are drawn from the row key, so the chosen, the
    rejected and the prompt text of one row agree. ``open_answer`` ends the text
    at the response marker, for generation.
    """
    form = style_of(style)
    prompt = F.lit(None).cast("string") if rewrite_prompt is None else rewrite_prompt
    system_index = choice(len(SYSTEM_PROMPTS), *key, salt=f"system|{seed}")
    if template_index is None:
        template = choice(len(QUERY_TEMPLATES), *key, salt=f"query|{seed}")
    else:
        template = F.lit(template_index)
    if form.layout == "base":
        text = base_text(original_text, rewritten_text, prompt, template)
    elif form.layout == "chat":
        messages = chat_messages(original_text, rewritten_text, prompt, template, system_index, form.with_system)
        text = render(messages, form.dialect)
    else:
        if system == "system" and not DIALECTS[form.dialect].system_turn:
            raise ValueError(f"{form.dialect} has no system turn; use system='mock'")
        messages = stack_messages(original_text, rewritten_text, prompt, examples, system, system_index)
        text = render(messages, form.dialect)
    return up_to_last(text, form.marker) if open_answer else text


def format_rows(df: DataFrame, style: str, key: list[str], out_col: str = "input", **options) -> DataFrame:
    """Adds the formatted text as one column."""
    return df.withColumn(out_col, formatted(style, key, **options))


def with_marker(df: DataFrame, style: str, column: str = "input") -> DataFrame:
    """Keep texts that hold the style's response marker, literally."""
    return df.where(F.contains(F.col(column), F.lit(style_of(style).marker)))
