"""Chat messages and their rendering, as column expressions.

A chat is ``array<struct<role, content>>``. A dialect turns it into the text a
tokenizer's chat template would give, less the begin and end markers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.fixed import (
    BASE_MARKER,
    MOCK_SYSTEM_REPLY,
    ORIGINAL_PREFIX,
    QUERY_TEMPLATES,
    REPLY_TO_ORIGINAL,
    REWRITTEN_PREFIX,
    START_RESPONSE,
    SYSTEM_PROMPTS,
)
from quillwork.functions.text import fill, fill_one_of, one_of, or_empty, remove_all, strip


@dataclass(frozen=True)
class Dialect:
    name: str
    boundary_tokens: tuple[str, ...]
    control_tokens: tuple[str, ...]
    system_turn: bool


# Boundary and control tokens of the three chat dialects
DIALECTS = {
    "gemma": Dialect("gemma", ("<bos>", "<eos>"), ("<start_of_turn>", "<end_of_turn>"), False),
    "llama": Dialect("llama", ("<s>", "</s>"), (), True),
    "mistral": Dialect("mistral", ("<s>", "</s>"), (), False),
}


@dataclass(frozen=True)
class Style:
    name: str
    layout: str  # "base", "chat" or "stack"
    dialect: str | None
    marker: str
    with_system: bool = False

    @property
    def answer_marker(self) -> str:
        """The marker as it reads once control tokens have been decoded away."""
        text = self.marker
        for token in DIALECTS[self.dialect].control_tokens if self.dialect else ():
            text = text.replace(token, "")
        return text


# The eight styles and their response markers
STYLES = {
    style.name: style
    for style in [
        Style("llama", "base", None, BASE_MARKER),
        Style("base", "base", None, BASE_MARKER),
        Style("gemma-it", "chat", "gemma", "<start_of_turn>model"),
        Style("mistral-it", "chat", "mistral", "[/INST]"),
        Style("llama-chat", "chat", "llama", "[/INST]", with_system=True),
        Style("mistral-message-stack", "stack", "mistral", f"[/INST]{START_RESPONSE}"),
        Style("llama-message-stack", "stack", "llama", f"[/INST] {START_RESPONSE}"),
        Style("gemma-message-stack", "stack", "gemma", f"<start_of_turn>model\n{START_RESPONSE}"),
    ]
}


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def example_messages(original_text, rewritten_text, rewrite_prompt) -> Column:
    """The four turns of one example: original, fixed reply, rewritten, prompt."""
    return F.array(
        message("user", fill(ORIGINAL_PREFIX + " {text}", text=original_text)),
        message("assistant", F.lit(REPLY_TO_ORIGINAL)),
        message("user", fill(REWRITTEN_PREFIX + " {text}", text=rewritten_text)),
        message("assistant", fill(START_RESPONSE + " {prompt}", prompt=or_empty(rewrite_prompt))),
    )


def opening_messages(system: str, system_index: Column) -> Column | None:
    """What precedes the examples: a mock exchange, a system turn or nothing."""
    chosen = one_of(SYSTEM_PROMPTS, system_index)
    if system == "mock":
        return F.array(message("user", chosen), message("assistant", F.lit(MOCK_SYSTEM_REPLY)))
    if system == "system":
        return F.array(message("system", chosen))
    if system == "none":
        return None
    raise ValueError(f"unknown system mode {system!r}; use one of mock, system, none")


def stack_messages(original_text, rewritten_text, rewrite_prompt, examples, system: str, system_index: Column) -> Column:
    """Opening, then four turns per example, then the four turns of the row."""
    parts = []
    opening = opening_messages(system, system_index)
    if opening is not None:
        parts.append(opening)
    if examples is not None:
        examples = F.col(examples) if isinstance(examples, str) else examples
        turns = F.transform(
            examples, lambda e: example_messages(e["original_text"], e["rewritten_text"], e["rewrite_prompt"])
        )
        parts.append(F.flatten(turns))
    parts.append(example_messages(original_text, rewritten_text, rewrite_prompt))
    return F.concat(*parts)


def chat_messages(
    original_text, rewritten_text, rewrite_prompt, template_index: Column, system_index: Column, with_system: bool
) -> Column:
    """One user turn holding the command and one assistant turn holding the prompt."""
    command = fill_one_of(
        QUERY_TEMPLATES, template_index, original_text=original_text, rewritten_text=rewritten_text
    )
    turns = [message("user", command), message("assistant", or_empty(rewrite_prompt))]
    if with_system:
        turns.insert(0, message("system", one_of(SYSTEM_PROMPTS, system_index)))
    return F.array(*turns)


def base_text(original_text, rewritten_text, rewrite_prompt, template_index: Column) -> Column:
    """Plain instruction format: the command, the marker and the prompt."""
    command = fill_one_of(
        QUERY_TEMPLATES, template_index, original_text=original_text, rewritten_text=rewritten_text
    )
    return fill("{command}\n" + BASE_MARKER + ": {prompt}", command=command, prompt=or_empty(rewrite_prompt))


def render(messages, dialect: str) -> Column:
    """Chat text in one dialect, with begin and end tokens removed from all of it."""
    messages = F.col(messages) if isinstance(messages, str) else messages
    if dialect == "gemma":
        turns = F.transform(
            messages,
            lambda m: F.concat(
                F.lit("<start_of_turn>"),
                F.when(m["role"] == "assistant", F.lit("model")).otherwise(m["role"]),
                F.lit("\n"),
                strip(m["content"]),
                F.lit("<end_of_turn>\n"),
            ),
        )
    elif dialect == "mistral":
        turns = F.transform(
            messages,
            lambda m: F.when(
                m["role"] == "user", F.concat(F.lit("[INST] "), m["content"], F.lit(" [/INST]"))
            ).otherwise(m["content"]),
        )
    elif dialect == "llama":
        first = F.get(messages, F.lit(0))
        system = F.when(
            first["role"] == "system", F.concat(F.lit("<<SYS>>\n"), first["content"], F.lit("\n<</SYS>>\n\n"))
        ).otherwise(F.lit(""))
        turns = F.transform(
            F.filter(messages, lambda m: m["role"] != "system"),
            lambda m, i: F.when(
                m["role"] == "user",
                F.concat(
                    F.lit("[INST] "),
                    strip(F.when(i == 0, F.concat(system, m["content"])).otherwise(m["content"])),
                    F.lit(" [/INST]"),
                ),
            ).otherwise(F.concat(F.lit(" "), strip(m["content"]), F.lit(" "))),
        )
    else:
        raise ValueError(f"unknown dialect {dialect!r}; use one of {', '.join(DIALECTS)}")
    return remove_all(F.array_join(turns, ""), *DIALECTS[dialect].boundary_tokens)
