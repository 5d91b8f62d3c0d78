"""Personal data: base patterns, and spans that boosted trees find among loose candidates.

The base patterns are certain and always stay. High-recall generators propose
overlapping spans beyond them, boosted trees judge these by format and context, and per kind a
threshold on the calibrated probability selects spans that overlap nothing chosen before. Format
features are those of the candidate with spelled signs undone, so they hold for spellings that nobody taught. The
trees learn from all documents, whose base spans are rewritten in place: into looser
forms that the base patterns miss (true) and into look-alikes such as dates, prices, amounts and failing checksums
(false). Candidates as they stand are false where a checksum or a range rules them out, and teach nothing
otherwise, so no hand labels are needed. Base spans themselves are no examples. Every example counts, in bins, trees and
thresholds alike: equal ones become one row with its counts, and trees and calibration are made of sums over those rows.

Defined results: a null text is empty and has no spans; documents with fewer than
``LEAST`` true or false examples give no model, and then the base spans are all;
equal texts give equal spans; an empty table gives no rows; repeated rows stay; further columns stay as they are; scanning takes time in proportion to the text, however long its runs.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.boosting import VECTORS, BoostedTrees, isotonic, packed, tallied, unpacked
from quillwork.llm.common import table
from quillwork.session import materialise

KINDS = ("email", "ip", "card", "phone")
LEAST = 30
#: Least calibrated probability of a span beyond the base patterns.
SURE = 0.9
#: Scores are counted by steps of 1 / STEPS, and those beyond FARTHEST with it, so what is calibrated does not grow with the table.
STEPS, FARTHEST = 1024, 64

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is tried at its begin alone: what follows it is the same from every place in it.
ADDRESS = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

# At signs and dots as writers spell them: bare, in brackets, as words.
AT = r"(?:\x20?(?:@|[(\[{<]\x20?(?:at|@)\x20?[)\]}>])\x20?)"
DOT = r"(?:\.|\x20\.\x20|\x20?[(\[{<]\x20?(?:dot|\.)\x20?[)\]}>]\x20?|\x20dot\x20)"
LABEL = "[A-Za-z0-9-]{1,63}"
LOOSE = {
    # a bare "at" needs a bare "dot" behind it: "look at example.com" is no address
    "email": re.compile(rf"[^\s@<>(){{}}\[\]\",;:]{{1,64}}(?:{AT}{LABEL}(?:{DOT}{LABEL}){{1,8}}|\x20at\x20{LABEL}(?:\x20dot\x20{LABEL}){{1,8}})", re.I),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\x20?[(\[{]\x20?(?:dot|\.)\x20?[)\]}]\x20?|\x20\.\x20|\x20dot\x20|[.,:])[0-9]{1,3}){3}(?![0-9])", re.I),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,3}[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00|\()?[0-9]{1,4}[\x20().\-/]{1,3}[0-9]{2,4}(?:[\x20().\-/]{0,3}[0-9]{2,4}){1,4}(?![0-9])"),
}
#: What a text without an at sign needs to hold an address.
SPELLED = re.compile(r"[(\[{<]\x20?at\x20?[)\]}>]|\x20at\x20[A-Za-z0-9-]{1,63}\x20dot\x20", re.I)
SIGN = re.compile(r"\x20?[(\[{<]\x20?(at|dot|[@.])\x20?[)\]}>]\x20?|\x20(at|dot|[@.])\x20|\x20?(@)\x20?", re.I)
PARTED = re.compile(r"[\x20._/-]+")
HINTS = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr", re.I),
    "card": re.compile(r"card|visa|credit|pay", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost and non-overlapping per kind, in order."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            found.append((start, 0, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    if DIGIT.search(text):
        for m in ADDRESS.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(only_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Overlapping proposals of all kinds: the loose patterns' spans and the base spans."""
    mail, digit = "@" in text or SPELLED.search(text), DIGIT.search(text)
    if not (mail or digit):
        return []
    found = set(base_spans(text))
    for kind, name in enumerate(KINDS):
        if mail if name == "email" else digit:
            found.update((m.start(), kind, m.end()) for m in LOOSE[name].finditer(text))
    return sorted(found)


def _class(char: str) -> int:
    return 0 if not char else 1 if char.isspace() else 2 if char.isdigit() else 3 if char.isalpha() else 4


def as_written(kind: int, found: str) -> str:
    """A candidate with spelled signs as signs, and a card's separators all as one: what its format is judged by, however it is disguised."""
    if KINDS[kind] in ("email", "ip"):
        return SIGN.sub(lambda m: {"at": "@", "dot": "."}.get(sign := (m[1] or m[2] or m[3]).lower(), sign), found)
    return PARTED.sub("-", found) if KINDS[kind] == "card" else found


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Whole numbers; none is above 711, the most characters that a loose pattern takes."""
    start, kind, end = span
    found = as_written(kind, text[start:end])
    digits, groups = only_digits(found), re.findall("[0-9]+", found)
    letters = sum(map(str.isalpha, found))
    left, right = text[max(0, start - 24) : start], text[end : end + 24]
    sizes = [len(g) for g in groups] or [0]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(found), len(digits), letters, sum(map(str.isupper, found)), found.count(" "), found.count("."), found.count("-"),
        found.count("(") + found.count("["), found.count("@"), float(found[:1] == "+"), len(groups), max(sizes), min(sizes), sizes[-1],
        float(12 <= len(digits) <= 19 and luhn(digits)), float(len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups)),
        len(set(digits)), len(found.rpartition(".")[2]), float(found[-1:].isalnum()),
        _class(text[start - 1 : start]), _class(text[end : end + 1]), float(bool(HINTS[KINDS[kind]].search(left))),
        len(DIGIT.findall(left)), len(DIGIT.findall(right)), len(re.findall(r"\S*$", left)[0]), len(re.match(r"\S*", right)[0]),
        float("=" in left[-3:]), float(start == 0 or text[start - 1] == "\n"),
        found.count(","), found.count(":"), found.count("/"), found.count("_"), sizes[0], sizes[min(1, len(sizes) - 1)],
        float(re.split(r"[.\s()\[\]]+", found)[-1].isalpha()), float(found[:1] == "("), float(digits[:2] in ("19", "20")),
        float(digits[:1] == "0"), len(set(re.findall("[^0-9]+", found))), len(found.partition("@")[0]), float(found.partition("@")[0].isdigit()),
    ]


ENDINGS = ("com", "org", "net", "io", "de", "fr", "info")
#: Characters of the text around a rewritten span that its candidates are sought in.
AROUND = 48


def variants(kind: int, found: str, rng: random.Random) -> tuple[list[str], list[str]]:
    """Looser forms of a base span, and look-alikes of its kind that are no personal data."""
    digits = only_digits(found)

    def number(size: int) -> str:
        return str(rng.randrange(10 ** (size - 1), 10**size))

    if KINDS[kind] == "email":
        local, _, domain = found.partition("@")
        price = f"{rng.randrange(1, 99)}.{rng.randrange(10, 99)}"
        word = re.sub("[^a-z]", "", local.lower()) or "it"
        # the base spans of a corpus may all be of one make, so names and domains are varied too
        short = word[: rng.randrange(2, 9)]
        names = [local, word, short, f"{short}.{word}", f"{short[0]}_{word}{number(1)}", f"{word}{number(2)}"]
        ends = [domain, ".".join(domain.split(".")[-2:]), f"{word}.{rng.choice(ENDINGS)}", f"{short}-{word}.{rng.choice(ENDINGS)}", f"{short}.{word}.{rng.choice(ENDINGS)}"]
        true = [f"{rng.choice(names)}{at}{rng.choice(ends).replace('.', dot)}" for at, dot in (
            (" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", "."), ("[at]", "."), (" @ ", "."), (" @ ", " (dot) "))]
        return true, [f"{number(1)} @ {price}", f"{word} @ {price}", f"{number(2)}[at]{price}", f"{word} (at) {price}", f"{word} @ {rng.randrange(1, 12)}.{rng.randrange(10, 60)}"]
    if KINDS[kind] == "ip":
        parts = found.split(".")
        true = [sep.join(parts) for sep in ("[.]", "(.)")] + [f"{parts[0]}[.]{'.'.join(parts[1:])}", f"{'.'.join(parts[:3])}[.]{parts[3]}"]
        wrong = [*parts]
        wrong[rng.randrange(4)] = str(rng.randrange(256, 999))
        amount = [str(rng.randrange(1, 999)), *(f"{rng.randrange(1000):03}" for _ in range(3))]
        return true, [*(sep.join(wrong) for sep in ("[.]", "(.)", ".")), ",".join(amount), ":".join(f"{rng.randrange(60):02}" for _ in range(4))]
    if KINDS[kind] == "card":
        off = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
        cut = [[d[k : k + 4] for k in range(0, len(d), 4)] for d in (digits, off)]
        true = [sep.join(cut[0]) for sep in (".", "_", "/")]
        return true, [off, *(sep.join(cut[1]) for sep in (".", "_", "/", " ", "-"))]
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    true = [f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{a}/{b}-{c}", f"0{a}-{b}{c}", f"0{a}/{b}{c}", f"0{a} {b} {c}"]
    if len(a) == 3:
        country = digits[:-10]
        true += [f"({a}) {b}-{c}", f"({a}) {b} {c}", f"00{country} {a} {b} {c}" if country else f"({a}){b}-{c}", f"{country}-{a}-{b}-{c}" if country else f"({a}) {b}.{c}"]
    year, month, day = rng.randrange(1900, 2060), f"{rng.randrange(1, 13):02}", f"{rng.randrange(1, 29):02}"
    false = [f"{year}-{month}-{day}", f"{day}.{month}.{year}", f"{month}/{day}/{year}", f"{day}-{month}-{year}", f"{year}-{year + 9} {number(2)}",
             f"{number(2)} {number(2)} {number(2)}", f"{number(3)} {number(3)} {number(3)}", f"{number(1)} {number(3)} {number(3)} {number(3)}",
             f"978-{number(1)}-{number(2)}-{number(4)}-{number(2)}", f"{number(3)}.{number(2)} {number(3)}.{number(2)}", f"{number(2)}.{number(2)}.{number(2)}",
             f"{number(4)} {number(4)} {number(4)} {number(4)}", f"{number(3)}-{number(2)}", f"{number(4)} {number(4)}", f"{number(3)}.{number(3)}.{number(3)}",
             f"{number(4)}.{number(2)} {number(4)}.{number(2)}", f"{number(4)}-{number(6)}", f"{number(4)}/{number(7)}"]
    return true, false


class Covered:
    """The places of a text that spans cover, as sorted stretches apart from each other: one binary search a question."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.begins, self.ends = [], []
        for begin, _, end in sorted(spans):
            if self.ends and begin < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.begins.append(begin)
                self.ends.append(end)

    def touches(self, begin: int, end: int) -> bool:
        at = bisect_left(self.begins, end)
        return at > 0 and self.ends[at - 1] > begin

    def add(self, begin: int, end: int) -> None:
        """Cover a stretch that touches none."""
        at = bisect_left(self.begins, end)
        self.begins.insert(at, begin)
        self.ends.insert(at, end)


def ruled_out(text: str, span: tuple[int, int, int]) -> bool:
    """Whether a candidate as it stands is none: a card whose checksum fails, an address with a part above 255."""
    kind, found = KINDS[span[1]], text[span[0] : span[2]]
    return kind == "card" and not luhn(only_digits(found)) or kind == "ip" and any(int(g) > 255 for g in re.findall("[0-9]+", found))


def excerpts(text: str) -> list[tuple[int, bool, str, str, str]]:
    """All that a text teaches by: kind, whether a base span, and the span between what stands around it; first the candidates that are ruled out."""
    base = base_spans(text)
    covered, out = Covered(base), []
    if DIGIT.search(text):
        for kind in map(KINDS.index, ("ip", "card")):  # no other is ever ruled out
            spans = ((m.start(), kind, m.end()) for m in LOOSE[KINDS[kind]].finditer(text))
            out += [c for c in spans if ruled_out(text, c) and not covered.touches(c[0], c[2])]
    spans = [*((c, False) for c in sorted(out)), *((c, True) for c in base)]
    return [(k, own, text[max(0, s - AROUND) : s], text[s:e], text[e : e + AROUND]) for (s, k, e), own in spans]


def examples(taught: list[tuple[int, bool, str, str, str]], rng: random.Random) -> list[tuple[int, list[float]]]:
    """(label, features) of candidates by a text's excerpts: of base spans rewritten in place, and of candidates that are ruled out."""
    out = []
    for kind, own, left, found, right in taught:
        if not own:
            out.append((0, features(left + found + right, (len(left), kind, len(left) + len(found)))))
            continue
        for label, forms in zip((1, 0), variants(kind, found, rng)):
            for form in forms:
                near, place = left + form + right, (len(left), kind, len(left) + len(form))
                known = base_spans(near)
                if any(place[0] < e and s < place[2] for s, _, e in known):
                    continue
                # what else is proposed at a rewritten span is false: another kind, or another extent
                for c in candidates(near):
                    if c[0] < place[2] and place[0] < c[2]:
                        out.append((int(label == 1 and c == place), features(near, c)))
    return out


@dataclass
class SpanModel:
    """Trees, their calibration, and by kind the least score of a span that is selected."""

    trees: BoostedTrees | None = None
    least: list[float] = field(default_factory=lambda: [np.inf] * len(KINDS))

    def select(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """All spans by text: the base spans and those selected beside them, in order."""
        chosen, covered, open_, rows = [], [], [], []
        for k, text in enumerate(texts):
            chosen.append(base_spans(text))
            covered.append(Covered(chosen[k]))
            if self.trees:
                for c in candidates(text):
                    if not covered[k].touches(c[0], c[2]):
                        open_.append((k, c))
                        rows.append(features(text, c))
        if rows:
            scores = self.trees.score(np.array(rows, float))
            for i in np.argsort(-scores, kind="stable").tolist():
                k, c = open_[i]
                if scores[i] >= self.least[c[1]] and not covered[k].touches(c[0], c[2]):
                    chosen[k].append(c)
                    covered[k].add(c[0], c[2])
        return [sorted(c) for c in chosen]


EXCERPTS = pa.list_(pa.struct([("kind", pa.int32()), ("own", pa.bool_()), ("left", pa.string()), ("found", pa.string()), ("right", pa.string())]))


def teaching(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Every example of ``docs`` as rows of distinct features with their fold and the counts of both labels."""

    def excerpted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, e) for h, t in zip(batch.column("hash").to_pylist(), batch.column("text").to_pylist()) if (e := excerpts(t))]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array([e for _, e in found], EXCERPTS)], ["hash", "taught"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict = defaultdict(lambda: [0, 0])
            for text_hash, taught in zip(batch.column("hash").to_pylist(), batch.column("taught").to_pylist()):
                order = int(text_hash[:12], 16)
                for label, x in examples([tuple(e.values()) for e in taught], random.Random(order)):
                    counts[order % 2, packed(x)][label] += 1
            columns = [[f for f, _ in counts], [x for _, x in counts], *([n[k] for n in counts.values()] for k in (0, 1))]
            kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["fold", "x", "n0", "n1"])

    held = docs.select(F.col(text_column).alias("text")).where(F.col("text").rlike("[0-9@]")).select(F.md5("text").alias("hash"), "text")
    taught = held.mapInArrow(excerpted, "hash string, taught array<struct<kind: int, own: boolean, `left`: string, found: string, `right`: string>>")
    # copies of a text teach once; of a text only its excerpts are shuffled. They are few bytes but much work, so their tasks are not to be merged by size
    distinct = taught.dropDuplicates(["hash"]).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = distinct.mapInArrow(counted, VECTORS)
    return rows.groupBy("fold", "x").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> SpanModel:
    """Learn from every document that holds a digit or an at sign: trees from one half of the distinct texts, thresholds from the other."""
    vectors = materialise(teaching(docs, text_column), "candidates")
    tally = tallied(vectors)
    whole = tally[tally["feature"] == 0]
    if whole[["n0", "n1"]].sum().min() < LEAST or whole.loc[whole["fold"] == 0, ["n0", "n1"]].sum().min() == 0:
        return SpanModel()
    trees = BoostedTrees().fit_table(vectors.where("fold = 0"), tally[tally["fold"] == 0])

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = unpacked(batch["x"].tolist())
                step = np.floor(np.clip(trees.score(x), -FARTHEST, FARTHEST) * STEPS).astype(np.int32)
                yield batch[["n0", "n1"]].assign(kind=x[:, : len(KINDS)].argmax(axis=1), step=step)

    judged_rows = vectors.where("fold = 1").mapInPandas(judged, "n0 bigint, n1 bigint, kind int, step int")
    counts = judged_rows.groupBy("kind", "step").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    model = SpanModel(trees)
    for k, held_out in counts.groupby("kind"):
        score, n0, n1 = (held_out[c].to_numpy() for c in ("step", "n0", "n1"))
        if (n0 + n1).sum() >= LEAST:
            steps, sure = isotonic(np.tile(score / STEPS, 2), np.repeat([0.0, 1.0], len(score)), np.concatenate([n0, n1]))
            if (sure >= SURE).any():
                model.least[k] = float(steps[np.argmax(sure >= SURE)])
    return model


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_spans(text: Column, model: SpanModel) -> Column:
    """Struct of the base spans' counts by kind, the base spans and all spans (joined)."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    def found(texts: pd.Series) -> pd.DataFrame:
        texts = texts.fillna("").tolist()
        base = [base_spans(t) for t in texts]
        counts = {f"n_{name}": [sum(b[1] == k for b in spans) for spans in base] for k, name in enumerate(KINDS)}
        return pd.DataFrame({**counts, "base": [joined(b) for b in base], "spans": [joined(s) for s in model.select(texts)]})

    return found(text)


def redact(text: Column, model: SpanModel) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        texts = texts.tolist()
        out = []
        for text, spans in zip(texts, model.select([t or "" for t in texts])):
            parts, done = [], 0
            for start, kind, end in spans:
                if start >= done:
                    parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
                done = max(done, end)
            out.append(text if not spans else "".join(parts) + text[done:])
        return pd.Series(out, dtype=object)

    return clean(text)


def redacted(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with redacted texts and their lengths in n_chars, where there is such a column."""
    out = docs.withColumn("text", redact(F.col("text"), model or fit(docs)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", find_spans(F.col("text"), fit(docs)).alias("found"))
    counts = [F.col(f"found.n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2("found.base", 256).alias("base_sha256"), F.col("found.spans").alias("spans"))
