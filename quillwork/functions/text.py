"""String functions with the exact split, strip and template rules of the data."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.fixed import INSTRUCTION_TEMPLATE, POLLUTION_QUESTION, WHITESPACE
from quillwork.functions.arrays import let


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def word_count(text) -> Column:
    """Pieces of ``text`` when cut at every single space: empty pieces count.

    Counted from byte lengths, so long texts are not cut into arrays.
    """
    text = _column(text)
    spaces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return (spaces + F.lit(1)).cast("int")


def fewer_words(text, n: int) -> Column:
    """``word_count(text) < n``, reading a long text only up to its n-th word."""
    text = _column(text)
    if n <= 1:
        return F.lit(False)
    return F.octet_length(F.substring_index(text, " ", n - 1)) == F.octet_length(text)


def join_texts(*columns) -> Column:
    """Newline-joined texts; null if any part is null, so the row can be rejected."""
    first, *rest = [_column(c) for c in columns]
    if not rest:
        return first
    return F.concat(first, *[piece for part in rest for piece in (F.lit("\n"), part)])


def strip(text) -> Column:
    """Remove Unicode white space at both ends (plain trim only removes spaces)."""
    return F.btrim(_column(text), F.lit(WHITESPACE))


def drop_first_line(text) -> Column:
    """Everything after the first newline; a text without newline is unchanged."""
    text = _column(text)
    at = F.instr(text, "\n")
    return F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(text)


def after_last(text, marker: str) -> Column:
    """Text after the last literal ``marker``, or all of it if there is none."""
    return F.substring_index(_column(text), marker, -1)


def up_to_last(text, marker: str) -> Column:
    """Text up to and with the last ``marker``; unchanged if there is none."""
    text = _column(text)
    tail = F.length(after_last(text, marker))
    return F.when(F.contains(text, F.lit(marker)), F.left(text, F.length(text) - tail)).otherwise(text)


def remove_all(text, *tokens: str) -> Column:
    """Drop every literal occurrence of each token."""
    text = _column(text)
    for token in tokens:
        text = F.replace(text, F.lit(token), F.lit(""))
    return text


def remove_echo(generated, given) -> Column:
    """Drop every occurrence of the input from a generated text."""
    generated, given = _column(generated), _column(given)
    return F.when(given == "", generated).otherwise(F.replace(generated, given, F.lit("")))


def or_empty(text) -> Column:
    return F.coalesce(_column(text), F.lit(""))


def fill(template: str, **fields) -> Column:
    """``template`` with its named fields replaced by columns.

    The template is taken apart once, on the driver. Field values are never
    parsed, so a text that holds ``{rewrite_prompt}`` stays as it is.
    """
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(_column(fields[name]))
    return F.concat(*pieces)


def fill_one_of(templates: list[str], index: Column, **fields) -> Column:
    """The template number ``index``, filled; only the chosen branch is evaluated."""
    chosen = F.when(index == 0, fill(templates[0], **fields))
    for number, template in enumerate(templates[1:], start=1):
        chosen = chosen.when(index == number, fill(template, **fields))
    return chosen


def one_of(values: list[str], index: Column) -> Column:
    chosen = F.when(index == 0, F.lit(values[0]))
    for number, value in enumerate(values[1:], start=1):
        chosen = chosen.when(index == number, F.lit(value))
    return chosen


def instruction(prompt) -> Column:
    """Wrap a prompt as the user turn of a generation input."""
    return fill(INSTRUCTION_TEMPLATE, prompt=prompt)


def pollution_question(prompt, text) -> Column:
    return fill(POLLUTION_QUESTION, prompt=prompt, text=text)


def token_containment(prompt, text) -> Column:
    """Share of the distinct lower-case tokens of ``prompt`` found in ``text``.

    Tokens lie between spaces and newlines. A token is looked for in the text with
    a space at both ends, so a long text is searched and never cut into an array.
    """

    def flat(value) -> Column:
        return F.replace(F.lower(_column(value)), F.lit("\n"), F.lit(" "))

    wanted = F.array_distinct(F.split(flat(prompt), " ", -1))
    return let(
        F.struct(wanted.alias("wanted"), F.concat(F.lit(" "), flat(text), F.lit(" ")).alias("text")),
        lambda v: F.when(
            v["text"].isNotNull(),
            F.size(F.filter(v["wanted"], lambda t: F.contains(v["text"], F.concat(F.lit(" "), t, F.lit(" ")))))
            / F.size(v["wanted"]),
        ),
    )
