"""Toxicity: a support vector machine on a gapped subsequence kernel with Nyström landmarks.

The units of a sentence are its words, freed of inserted marks, and runs of
single letters read as one word. The kernel counts common subsequences of three symbols that
span at most five, each gap weakening them, so gaps and inserted characters lower a
match but do not undo it. Landmarks are units and word beginnings that set toxic from clean
documents apart, and common clean units. A sentence is as toxic as its worst unit: the
machine is trained on labelled sentences, whose witness is chosen anew each round.

In the landmarks' span the decision is linear in the subsequences, so a trained
machine is one table of their weights, and scoring a word is a few look-ups. A document's score is a
logistic fit, on documents that trained nothing, of its two worst units and the number of clear ones.

Defined results: null and blank texts have no units and get the score of that;
without labels of both kinds every score is the share of toxic labels (0 without any); equal
texts have equal scores; labels whose document is missing, or null, teach nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.common import first_by_hash, held_out, table
from quillwork.session import materialise

#: Most documents that landmarks and machine, and that the logistic fit, learn from; most sentences.
LEARN_DOCS = 12_000
FIT_DOCS = 8000
SENTENCES = 8000
#: Clean units that a round adds.
HARD = 3000
LANDMARKS = 512
#: Root of twice the log likelihood ratio above which a unit is taken to tell toxic from clean.
SURE = 5.0
#: Units that stand apart or are common, told to the driver at most.
TOLD = 3000
ROUNDS = 4
GAP = 0.6
STEPS = [(j, k) for k in range(2, 5) for j in range(1, k)]
END, BEGIN, SKIP = 61, 62, 63
#: Longest unit that is one piece; longer ones are cut with an overlap.
PIECE, OVERLAP = 48, 8
CACHED = 400_000
CUT = 0.7
#: Decisions beyond this, either way, tell no more; and where a unit is clearly toxic.
LEVEL, CLEAR = 1.1, 0.8
STEMS = (4, 5, 6)

SYMBOL = np.full(128, SKIP, np.uint8)
SYMBOL[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789"]] = np.arange(36)
SENTENCE = re.compile(r"[.!?\n]+\s*")


def symbols(units: list[str], ended: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all units one after another, each with its ends marked, and where each unit begins.

    Small letters and digits have a symbol each, other ASCII characters none, and characters beyond share 25.
    """
    sizes = np.fromiter(map(len, units), np.int64, count=len(units))
    code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = np.where(code < 128, SYMBOL[np.minimum(code, 127)], (36 + code % 25).astype(np.uint8))
    owner = np.repeat(np.arange(len(units)), sizes)[plain != SKIP]
    plain = plain[plain != SKIP]
    sizes = np.bincount(owner, minlength=len(units)) + (2 if ended else 1)
    begins = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), END, np.uint8)
    out[begins] = BEGIN
    out[np.arange(len(plain)) + owner * (1 if not ended else 2) + 1] = plain
    return out, begins


def subsequences(units: list[str], ended: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(unit, code, weight) of every subsequence of three symbols within five, by the gaps they have."""
    text, begins = symbols(units, ended)
    owner = np.repeat(np.arange(len(units)), np.diff(np.append(begins, len(text))))
    wide = text.astype(np.int32)
    for j, k in STEPS:
        if len(text) > k:
            same = owner[:-k] == owner[k:]
            code = (wide[:-k] << 12 | wide[j : len(wide) - k + j] << 6 | wide[k:])[same]
            yield owner[:-k][same], code, GAP ** (k - 2)


def scale(units: list[str], ended: bool = True) -> np.ndarray:
    """What a unit's kernel values are divided by: it grows as the fourth root of its squared weights."""
    total = np.zeros(len(units))
    for unit, _, weight in subsequences(units, ended):
        total += np.bincount(unit, minlength=len(units)) * weight**2
    return np.maximum(total, 1.0) ** 0.25


class Machine:
    """Landmarks, and the trained decision as a table of subsequence weights."""

    def __init__(self, landmarks: list[tuple[str, bool]]):
        """Landmarks are (unit, whether its end counts)."""
        landmarks = sorted(landmarks, key=lambda mark: not mark[1])
        whole, parts = [u for u, e in landmarks if e], [u for u, e in landmarks if not e]
        groups = [(u, e) for u, e in ((whole, True), (parts, False)) if u]
        found = [(n + off, c, w) for off, (u, e) in zip(itertools.accumulate([0] + [len(u) for u, _ in groups]), groups) for n, c, w in subsequences(u, e)]
        codes = np.unique(np.concatenate([c for _, c, _ in found]))
        self.column = np.full(1 << 18, -1, np.int32)
        self.column[codes] = np.arange(len(codes))
        self.codes = codes
        self.vectors = np.zeros((len(landmarks), len(codes)), np.float32)
        for n, c, w in found:
            np.add.at(self.vectors, (n, self.column[c]), w)
        self.vectors /= np.concatenate([scale(u, e) for u, e in groups])[:, None].astype(np.float32)
        value, vector = np.linalg.eigh((self.vectors @ self.vectors.T).astype(float))
        keep = value > 1e-5 * value.max()
        self.whiten = vector[:, keep] / np.sqrt(value[keep])
        self.table = np.zeros(1 << 18, np.float32)
        self.bias = 0.0

    def embed(self, units: list[str]) -> np.ndarray:
        """Nyström features of units, and a one."""
        basis = self.vectors.T @ self.whiten.astype(np.float32)
        out = np.zeros((len(units), basis.shape[1] + 1), np.float32)
        for begin in range(0, len(units), 2000):
            part = units[begin : begin + 2000]
            for unit, code, weight in subsequences(part):
                column = self.column[code]
                known = column >= 0
                np.add.at(out[:, :-1], unit[known] + begin, weight * basis[column[known]])
        out /= scale(units)[:, None]
        out[:, -1] = 1
        return out

    def train(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> None:
        """Squared hinge loss by Newton steps over the rows that are not yet beyond their margin."""
        w = np.zeros(x.shape[1])
        weight = weight / weight.sum()
        pull = ridge * np.eye(len(w))
        pull[-1, -1] = 1e-6

        def loss(f: np.ndarray, w: np.ndarray) -> float:
            return float(w @ pull @ w / 2 + (weight * np.maximum(0, 1 - y * f) ** 2).sum())

        f = x @ w
        for _ in range(30):
            active = np.flatnonzero(y * f < 1)
            xa = x[active]
            slope = pull @ w + 2 * (weight[active] * (f[active] - y[active])) @ xa
            curve = np.asarray(2 * (xa * weight[active, None].astype(x.dtype)).T @ xa, float) + pull
            step = np.linalg.solve(curve, slope)
            move, size, now = x @ step, 1.0, loss(f, w)
            while size > 1e-3 and loss(f - size * move, w - size * step) > now:
                size /= 2
            w, f = w - size * step, f - size * move
            if now - loss(f, w) < 1e-9:
                break
        self.bias = float(w[-1])
        self.table[:] = 0
        self.table[self.codes] = self.vectors.T @ (self.whiten @ w[:-1])

    def decide(self, units: list[str]) -> np.ndarray:
        total = np.zeros(len(units))
        for unit, code, weight in subsequences(units):
            total += weight * np.bincount(unit, self.table[code], minlength=len(units))
        return total / scale(units) + self.bias


def pieces(token: str) -> list[str]:
    return [token[k : k + PIECE] for k in range(0, max(1, len(token) - OVERLAP), PIECE - OVERLAP)] if len(token) > PIECE else [token]


def units_of(text: str) -> list[str]:
    """Words, cut if very long, and runs of three or more single characters as one word each."""
    tokens = text.lower().split()
    out = [p for t in tokens for p in pieces(t)] if any(len(t) > PIECE for t in tokens) else tokens
    sizes = np.fromiter(map(len, tokens), np.int64, count=len(tokens))
    single = np.flatnonzero(np.diff(np.concatenate([[0], (sizes == 1).view(np.int8), [0]])))
    runs = ["".join(tokens[a:b]) for a, b in zip(single[::2], single[1::2]) if b - a > 2]
    return out + [p for r in runs for p in pieces(r)] if runs else out


@dataclass
class Toxicity:
    machine: Machine | None
    weights: np.ndarray
    share: float = 0.0

    def evidence(self, texts: list[str]) -> np.ndarray:
        """By text: second worst and worst unit, number of clearly toxic units, and whether there is a unit."""
        rows = np.zeros((len(texts), 4))
        cache = self.__dict__.setdefault("cache", {})
        for k, text in enumerate(texts):
            units = units_of(text)
            if not units:
                continue
            new = list(set(units).difference(cache))
            if len(cache) > CACHED:
                cache.clear()
                new = list(set(units))
            for begin in range(0, len(new), 100_000):
                part = new[begin : begin + 100_000]
                cache.update(zip(part, self.machine.decide(part).tolist()))
            f = np.fromiter(map(cache.__getitem__, units), np.float64, count=len(units))
            top = np.sort(np.append(f, [-LEVEL] * 2) if len(f) < 2 else np.partition(f, -2)[-2:])[-2:]
            rows[k] = *(np.clip(top, -LEVEL, LEVEL) + LEVEL), np.log1p((f > CLEAR).sum()), 1
        return rows

    def score(self, texts: list[str]) -> np.ndarray:
        if self.machine is None:
            return np.full(len(texts), self.share)
        return 1 / (1 + np.exp(-(self.evidence(texts) @ self.weights[:-1] + self.weights[-1])))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _unit_rows(batches):
    """(unit, stem, toxic) once per document for each of its units and word beginnings."""
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            units = {u for u in map(_clean, units_of(text)) if u}
            stems = {u[:n] for u in units for n in STEMS if len(u) > n}
            yield pd.DataFrame({"unit": [*units, *stems], "stem": [False] * len(units) + [True] * len(stems), "toxic": int(toxic)})


def _decided(machine: Machine):
    def run(batches):
        for batch in batches:
            yield batch.assign(f=machine.decide(batch["unit"].tolist()))

    return run


def _clean(unit: str) -> str:
    return unit if unit.isalnum() else "".join(c for c in unit if c.isalnum() or ord(c) >= 128)


def sentences_of(text: str, most: int = 40) -> Iterator[list[str]]:
    for sentence in SENTENCE.split(text):
        units = [u for u in map(_clean, units_of(sentence)) if u]
        for k in range(0, len(units), most):
            yield units[k : k + most]


def fit(docs: DataFrame, labels: DataFrame, learn_docs: int = LEARN_DOCS, fit_docs: int = FIT_DOCS, n_landmarks: int = LANDMARKS) -> Toxicity:
    """Learn from the texts of ``docs`` that ``labels`` (doc_id, toxic) speak of.

    Of the labels, the first in the order of a hash are taken: ``learn_docs`` for landmarks and machine, a third of
    them toxic if there are as many, and ``fit_docs`` others, as labels fall, for the logistic fit. Only texts of these are moved.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .where("toxic = _most").select(F.col("doc_id").alias("_id"), "toxic", F.md5(F.concat(F.lit("toxicity|"), F.col("doc_id").cast("string"))).alias("_hash"))
    )
    odd = F.substring("_hash", 32, 1).isin(*"13579bdf")
    n_labels = {(r["odd"], r["toxic"]): r["count"] for r in known.groupBy(odd.alias("odd"), "toxic").count().collect()}
    whole = sum(n_labels.values())
    none = Toxicity(None, np.zeros(5), sum(c for (_, t), c in n_labels.items() if t) / whole if whole else 0.0)
    wanted = {1: learn_docs // 3, 0: learn_docs - learn_docs // 3}
    taken = [first_by_hash(known.where(~odd & (F.col("toxic") == t)), "_hash", n, n_labels.get((False, t), 0)).withColumn("_use", F.lit("learn")) for t, n in wanted.items()]
    taken.append(first_by_hash(known.where(odd), "_hash", fit_docs, n_labels.get((True, 0), 0) + n_labels.get((True, 1), 0)).withColumn("_use", F.lit("fit")))
    ids = materialise(taken[0].unionByName(taken[1]).unionByName(taken[2]).drop("_hash"), "labels")
    # copies of a text teach once
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id")).where("text IS NOT NULL")
    sample = materialise(texts.groupBy("_use", "toxic", F.md5("text").alias("_text")).agg(F.first("text").alias("text")), "labelled")
    parallel = max(2, docs.sparkSession.sparkContext.defaultParallelism)
    learn = sample.where("_use = 'learn'").select("text", "toxic").repartition(parallel)
    held = sample.where("_use = 'fit'").select("text", "toxic").repartition(parallel)
    n = {r["toxic"]: r["count"] for r in sample.where("_use = 'learn'").groupBy("toxic").count().collect()}
    if min(n.get(0, 0), n.get(1, 0)) == 0:
        return none
    counts = materialise(
        learn.mapInPandas(_unit_rows, "unit string, stem boolean, toxic int")
        .groupBy("unit", "stem").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
        .withColumns({"p": (F.col("a") + 0.5) / (n[1] + 1), "q": (F.col("b") + 0.5) / (n[0] + 1)})
        # signed root of the likelihood ratio: how far the unit is from telling nothing
        .withColumn("apart", F.signum(F.log(F.col("p") / F.col("q"))) * F.sqrt(F.greatest(F.lit(0.0), 2 * (
            F.col("a") * F.log(F.greatest(F.col("p") * (n[0] + n[1] + 2) / (F.col("a") + F.col("b") + 1), F.lit(1e-9)))
            + F.col("b") * F.log(F.greatest(F.col("q") * (n[0] + n[1] + 2) / (F.col("a") + F.col("b") + 1), F.lit(1e-9)))))))
        .where("a + b > 1 OR b > 0"),
        "units",
    )
    told = counts.where("a >= 2 AND apart > 2").orderBy(F.desc("apart"), "unit", "stem").limit(TOLD // 3).toPandas()
    common = counts.where("NOT stem AND apart < 1 AND b > 0").orderBy(F.desc("b"), "unit").limit(TOLD - TOLD // 3).toPandas()
    sure = told[told["apart"] > SURE] if (told["apart"] > SURE).any() else told[told["apart"] > SURE / 2]
    if len(sure) == 0 or len(common) == 0:
        return none
    marks = list(dict.fromkeys([(u, not s) for u, s in zip(sure["unit"], sure["stem"])]))[: n_landmarks // 3]
    marks += [(u, True) for u in common["unit"] if (u, True) not in marks][: n_landmarks // 3]
    machine = Machine(marks)
    weight = {(u, s): a for u, s, a in zip(sure["unit"], sure["stem"], sure["apart"])}

    def told_by(unit: str) -> float:
        return max([weight.get((unit, False), 0.0), *(weight.get((unit[:k], True), 0.0) for k in STEMS if len(unit) > k)])

    def sentence_rows(batches):
        for batch in batches:
            for text in batch["text"]:
                found = [s for s in sentences_of(text) if any(told_by(u) > 0 for u in s)]
                if found:
                    order = [hashlib.md5("\n".join(s).encode("utf-8", "surrogatepass")).hexdigest() for s in found]
                    yield pd.DataFrame({"units": found, "order": order})

    drawn = learn.where("toxic = 1").mapInPandas(sentence_rows, "units array<string>, order string")
    bad = [list(u) for u in drawn.orderBy("order").limit(SENTENCES).toPandas()["units"]]
    # only units that tell can be witnesses, else common words of the same sentences would become toxic
    bad = [[u for u in s if told_by(u) > 0] for s in bad]
    witness = [max(s, key=lambda u: (told_by(u), u)) for s in bad]
    clean = dict(zip(common["unit"], common["b"]))
    seen = counts.where("NOT stem AND b > 0").where(F.col("apart") < SURE).select("unit", "b")
    for turn in range(ROUNDS + 1):
        n_bad = Counter(witness)
        units, against = sorted(n_bad), sorted(clean)
        up, down = np.sqrt([n_bad[u] for u in units]), np.sqrt([clean[u] for u in against])
        y = np.concatenate([np.ones(len(units)), -np.ones(len(against))])
        machine.train(machine.embed(units + against), y, np.concatenate([up / up.sum(), down / down.sum()]))
        if turn < ROUNDS:
            # the worst units of all clean sentences: they are trained against, and some become landmarks
            hard = seen.mapInPandas(_decided(machine), "unit string, b double, f double").orderBy(F.desc("f"), "unit").limit(HARD).toPandas()
            clean.update(zip(hard["unit"], hard["b"]))
            if turn == 0:
                marks += [(u, True) for u in hard["unit"] if (u, True) not in marks][: n_landmarks - len(marks)]
                machine = Machine(marks)
            else:
                every = sorted({u for s in bad for u in s})
                scored = dict(zip(every, machine.decide(every).tolist()))
                witness = [max(s, key=lambda u: (scored[u], u)) for s in bad]
    machine.vectors = machine.whiten = machine.column = None  # the table is all that scoring needs
    model = Toxicity(machine, np.zeros(5), none.share)

    def evidence_rows(batches):
        for batch in batches:
            found = model.evidence(batch["text"].tolist())
            yield pd.DataFrame({"x": found.tolist(), "toxic": batch["toxic"].astype(int)})

    shown = held.mapInPandas(evidence_rows, "x array<double>, toxic int").toPandas()
    if shown["toxic"].nunique() < 2:
        return none
    model.weights = logistic(np.array(shown["x"].tolist()), shown["toxic"].to_numpy(float))
    model.__dict__.pop("cache", None)
    return model


def toxic_score(text: Column, model: Toxicity) -> Column:
    shared = model

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.score(texts.fillna("").tolist()))

    return scored(text)


def learned(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """The model of the labelled documents that are not held out; texts and labels are all it sees."""
    return fit(docs, labels.where(~held_out()).select("doc_id", "toxic"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select(
        "doc_id", held_out().alias("held_out"), toxic_score(F.col("text"), learned(docs, table(spark, sf_dir, "labels"))).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
