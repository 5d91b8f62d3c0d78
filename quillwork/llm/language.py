"""Language identification of words in code-switched text by a linear-chain conditional random field.

A word's state scores are sums of the weights of its features: its affixes, its character
n-grams, and itself in a lexicon learned from the sample. Learned transitions join
neighbours, and forward-backward gives each word's probabilities. A document's
language is that of its words on average.

Forward-backward is exact, whatever the text's length. With few languages it is done in blocks of
words: products of the blocks' matrices carry the state from block to block, and all blocks of a slice of
documents are worked on together. With many, whose matrices would be large, it goes word by word
through all sequences of a slice. A word of any length has all its n-grams, as text without spaces needs.

The number of languages is not bounded: model and time for a word grow with it (the time of the chain with its square).

Defined results: a null text, or one without a letter (combining marks are none), is ``und`` with score 0;
without labelled rows every text is ``und``; words without letters take part in the chain with no
evidence of their own; ties go to the language that sorts first; equal texts have equal results;
an empty table gives no rows; a row is its own result, so repeated rows stay; further columns of whatever name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quillwork.llm.common import SLICE_BYTES, held_out, slices, table

#: Documents of each language that are learned from, words of each, and characters of a word, at most.
SAMPLE_DOCS = 300
SAMPLE_WORDS = 200
SAMPLE_SIGNS = 200
#: Documents of all languages that are learned from: many languages share them evenly, with 20 each at least.
SAMPLE_ALL = 6_000
SEGMENT = (4, 30)
BUCKETS = 1 << 16
EPOCHS, BATCH, RATE, RIDGE = 6, 64, 0.3, 1e-5
BLOCK = 32
#: Languages up to which long sequences are worked on in blocks, whose matrices cost the number's cube.
FEW = 16
#: Characters whose features are worked out at once; a longer word is scored piece by piece.
PIECE = 1 << 18
PRIME = np.uint64(1_000_003)
UNKNOWN = "und"


def _mixed(code: np.ndarray, salt: int) -> np.ndarray:
    code = (code + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return (code >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _grams(code: np.ndarray, sizes: tuple[int, ...] = (1, 2, 3, 4)) -> Iterator[tuple[int, np.ndarray]]:
    """(n, bucket of the n-gram that begins at each character)."""
    gram = np.zeros(len(code), np.uint64)
    for n in sizes:
        if len(code) < n:
            return
        gram = gram[: len(code) - n + 1] * PRIME + code[n - 1 :]
        yield n, _mixed(gram, n)


def _polynomial(code: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Each character times the power of its place in the word; the sum stands for the word."""
    return code * np.uint64(6364136223846793005) ** place.astype(np.uint64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every feature: n-grams of 1 to 4 characters with word marks, affixes up to 4, the word."""
    code = _codes("".join(f"\x02{w}\x03" for w in words))
    sizes = np.fromiter(map(len, words), np.int64, count=len(words)) + 2
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    who, what = [], []
    for n, gram in _grams(code):
        same = owner[: len(gram)] == owner[n - 1 :]
        who.append(owner[: len(gram)][same])
        what.append(gram[same])
    # the word as a whole
    place = np.arange(len(code)) - np.repeat(begins, sizes)
    whole = np.add.reduceat(_polynomial(code, place), begins) if len(words) else np.zeros(0, np.uint64)
    who.append(np.arange(len(words)))
    what.append(_mixed(whole, 99))
    for k in range(2, 5):  # longer affixes than the n-grams with marks hold
        long_enough = np.flatnonzero(sizes > k + 1)
        for salt, first in ((20 + k, begins[long_enough]), (40 + k, begins[long_enough] + sizes[long_enough] - k - 1)):
            value = np.zeros(len(long_enough), np.uint64)
            for j in range(k + 1):
                value = value * PRIME + code[first + j]
            who.append(long_enough)
            what.append(_mixed(value, salt))
    return np.concatenate(who), np.concatenate(what)


def long_word(word: str, piece: int = PIECE) -> np.ndarray:
    """How often each bucket is a feature of one word, worked out piece by piece."""
    size, found = len(word) + 2, np.zeros(BUCKETS, np.int64)
    whole, marked = np.zeros(1, np.uint64), f"\x02{word}\x03"
    for begin in range(0, size, piece):
        # three characters more, so that n-grams that begin in this piece are whole
        code = _codes(marked[begin : begin + piece + 3])
        for _, gram in _grams(code):
            found += np.bincount(gram[:piece], minlength=BUCKETS)
        own = code[:piece]
        whole += _polynomial(own, np.arange(begin, begin + len(own))).sum(dtype=np.uint64)
    found[_mixed(whole, 99)] += 1
    for k in range(2, 5):
        if size > k + 1:
            for salt, affix in ((20 + k, marked[: k + 1]), (40 + k, marked[-k - 1 :])):
                value = np.zeros(1, np.uint64)
                for c in _codes(affix):
                    value = value * PRIME + c
                found[_mixed(value, salt)] += 1
    return found


def state_scores(words: list[str], weights: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Scores (word, language): the mean weight of the word's features times the root of their number."""
    scores = np.zeros((len(words), weights.shape[1]))
    ends = np.cumsum([len(w) + 2 for w in words]) if words else np.zeros(0, np.int64)
    begin = 0
    while begin < len(words):
        if len(words[begin]) > piece:
            found = long_word(words[begin], piece)
            scores[begin] = found @ weights / np.sqrt(found.sum())
            begin += 1
            continue
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + piece, side="right")))
        who, what = features(words[begin:end])
        n = np.maximum(np.bincount(who, minlength=end - begin), 1)
        for k in range(weights.shape[1]):
            scores[begin:end, k] = np.bincount(who, weights[what, k], end - begin) / np.sqrt(n)
        begin = end
    return scores


def forward_backward(scores: np.ndarray, starts: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, expected neighbour pairs), a word of every sequence at a time. Memory grows
    with words times languages."""
    n, k = scores.shape
    pairs = np.zeros((k, k))
    if n == 0:
        return scores, pairs
    sizes = np.diff(np.append(starts, n))
    order = np.argsort(-sizes, kind="stable")
    begin, size = np.asarray(starts)[order], sizes[order]
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    found, state = np.empty((n, k)), np.ones((len(size), k))
    # how many sequences have a word at place t: they come first
    live = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    for t, m in enumerate(live):
        at = begin[:m] + t
        state = local[at] * (state[:m] @ step if t else 1.0)
        state /= state.sum(axis=1, keepdims=True)
        found[at] = state
    after = np.ones((len(size), k))
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        at = begin[:m] + t
        behind = after[:m] * local[at]
        if t:
            before = found[at - 1]
            total = np.einsum("nk,nk->n", before @ step, behind)
            pairs += step * (before.T @ (behind / total[:, None]))
        found[at] *= after[:m]
        behind = behind @ step.T
        after[:m] = behind / behind.sum(axis=1, keepdims=True)
    return found / found.sum(axis=1, keepdims=True), pairs


def posteriors(scores: np.ndarray, starts: np.ndarray, transition: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Probabilities (word, language) by forward-backward; ``starts`` holds where each sequence begins.

    Sequences are padded to whole blocks with words that change nothing.
    """
    n, k = scores.shape
    if n == 0:
        return scores
    if k > FEW:
        return forward_backward(scores, starts, transition)[0]
    sizes = np.diff(np.append(starts, n))
    blocks = -(-sizes // block)
    first = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    place = np.arange(n) - np.repeat(starts, sizes) + np.repeat(first, sizes) * block
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    emit = np.ones((total * block, k))
    emit[place] = local
    real = np.zeros(total * block, bool)
    real[place] = True
    emit, real = emit.reshape(total, block, k), real.reshape(total, block)
    opens = np.zeros(total, bool)
    opens[first[blocks > 0]] = True
    # a sequence's first word has no transition before it
    enter = np.where(opens[:, None, None], np.eye(k), step)
    # a block's matrix takes the state before its first word to the state after its last
    carry = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(block):
        moved = (carry @ (enter if t == 0 else step)) * emit[:, t, None, :]
        moved /= moved.sum(axis=(1, 2), keepdims=True)
        carry = np.where(real[:, t, None, None], moved, carry)
    # states at the blocks' edges, block by block, all sequences together
    before, after = np.ones((total, k)), np.ones((total, k))
    order = np.argsort(-blocks, kind="stable")
    lead = blocks[order]
    most = int(lead[0])
    for b in range(1, most):
        at = first[order[: int(np.searchsorted(-lead, -b))]] + b
        state = np.einsum("nk,nkj->nj", before[at - 1], carry[at - 1])
        before[at] = state / state.sum(axis=1, keepdims=True)
    for b in range(most - 2, -1, -1):
        at = first[order[: int(np.searchsorted(-lead, -(b + 1)))]] + b
        state = np.einsum("njk,nk->nj", carry[at + 1], after[at + 1])
        after[at] = state / state.sum(axis=1, keepdims=True)
    forward = np.empty((total, block, k))
    state = before
    for t in range(block):
        moved = np.where(opens[:, None], state, state @ step) if t == 0 else state @ step
        state = np.where(real[:, t, None], moved * emit[:, t], state)
        state = state / state.sum(axis=1, keepdims=True)
        forward[:, t] = state
    state = after
    for t in range(block - 1, -1, -1):
        forward[:, t] *= state
        state = np.where(real[:, t, None], (state * emit[:, t]) @ step.T, state)
        state = state / state.sum(axis=1, keepdims=True)
    found = forward.reshape(-1, k)[place]
    return found / found.sum(axis=1, keepdims=True)


@dataclass
class Field:
    """A trained field: languages in order, feature weights and transitions."""

    languages: list[str]
    weights: np.ndarray
    transition: np.ndarray

    def label(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Words of all texts, where each text's words begin, whether a word has letters, and its probabilities."""
        split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        words = split.flatten()
        empty = pc.equal(words, "")
        counts = np.diff(split.offsets.to_numpy())
        if pc.any(empty).as_py():
            owner = np.repeat(np.arange(len(texts)), counts)[~empty.to_numpy(zero_copy_only=False)]
            words, counts = words.filter(pc.invert(empty)), np.bincount(owner, minlength=len(texts))
        starts = np.cumsum(counts) - counts
        coded = words.dictionary_encode()
        listed = pc.replace_substring_regex(coded.dictionary, r"[^\pL\pM]+", "")
        lettered = pc.match_substring_regex(listed, r"\pL").to_numpy(zero_copy_only=False)
        scores = np.zeros((len(listed), len(self.languages)))
        known = np.flatnonzero(lettered)
        spelled = listed.take(pa.array(known)).to_pylist()
        scores[known] = state_scores(spelled, self.weights)
        code = coded.indices.to_numpy()
        used = np.flatnonzero(counts)
        found = posteriors(scores[code], starts[used], self.transition)
        return words, starts, lettered[code], found

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        words, starts, lettered, found = self.label(texts)
        ends = np.append(starts[1:], len(words))
        heard = np.vstack([np.zeros((1, found.shape[1])), np.cumsum(found * lettered[:, None], axis=0)])
        total = heard[ends] - heard[starts]
        n = total.sum(axis=1)
        share = total / np.maximum(n, 1e-300)[:, None]
        best = share.argmax(axis=1)
        there = n > 0.5
        names = [self.languages[b] if t else UNKNOWN for b, t in zip(best, there)]
        return names, np.where(there, np.clip(share[np.arange(len(best)), best], 0, 1), 0.0)


def slice_bytes(languages: int) -> int:
    """Text bytes that are worked on at once: probabilities take a number for each word and language."""
    return SLICE_BYTES // 2 // max(1, languages // 8)


def _words(text: str) -> list[str]:
    split = pc.utf8_split_whitespace(pa.array([text.lower()])).flatten()
    spelled = pc.replace_substring_regex(split, r"[^\pL\pM]+", "")
    return spelled.filter(pc.match_substring_regex(spelled, r"\pL")).to_pylist()


def sequences(rows: list[tuple[list[str], int]], rng: np.random.Generator) -> list[list[tuple[str, int]]]:
    """Code-switched sequences: segments of documents, mixed over languages, some of them next to their own kind."""
    segments = []
    for words, language in rows:
        at = 0
        while at < len(words):
            size = int(rng.integers(*SEGMENT))
            segments.append([(w, language) for w in words[at : at + size]])
            at += size
    order = rng.permutation(len(segments))
    return [sum((segments[i] for i in order[k : k + 3]), []) for k in range(0, len(order), 3)]


def train(rows: list[tuple[list[str], int]], languages: list[str], seed: int = 0) -> Field:
    """Maximum likelihood by adaptive gradient steps; gradients come from exact forward-backward."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    weights, transition = np.zeros((BUCKETS, k)), np.zeros((k, k))
    speed, speed_t = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6)
    chains = sequences(rows, rng)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // BATCH)):
            chain = [chains[i] for i in batch]
            starts = np.cumsum([0, *map(len, chain)])[:-1]
            pairs = [p for c in chain for p in c]
            listed = sorted({w for w, _ in pairs})
            at = {w: i for i, w in enumerate(listed)}
            code = np.array([at[w] for w, _ in pairs])
            truth = np.array([y for _, y in pairs])
            who, what = features(listed)
            n = np.bincount(who, minlength=len(listed))
            scores = state_scores(listed, weights)[code]
            found, joint = forward_backward(scores, starts, transition)
            off = found.copy()
            off[np.arange(len(truth)), truth] -= 1
            by_word = np.zeros((len(listed), k))
            np.add.at(by_word, code, off)
            touched, where = np.unique(what, return_inverse=True)
            each = (by_word / np.sqrt(n)[:, None])[who]
            grad = np.stack([np.bincount(where, each[:, j], len(touched)) for j in range(k)], axis=1) / len(pairs) + RIDGE * weights[touched]
            speed[touched] += grad**2
            weights[touched] -= RATE * grad / np.sqrt(speed[touched])
            # transitions: pairs of neighbours, expected less seen
            inner = np.ones(len(pairs), bool)
            inner[starts] = False
            right = np.flatnonzero(inner)
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[right - 1], truth[right]), 1)
            step = (joint - seen) / len(pairs)
            speed_t += step**2
            transition = transition - RATE * step / np.sqrt(speed_t)
    return Field(languages, weights.astype(np.float32), transition)


def fit(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, sample_signs: int = SAMPLE_SIGNS, sample_all: int = SAMPLE_ALL
) -> Field:
    """Learn from (text, lang): of each language the first ``sample_docs`` texts by a hash (fewer if all languages
    together would have more than ``sample_all``, but 20 at least), of each text the ``sample_words`` words from a place that
    the hash picks, and of a word the ``sample_signs`` characters from such a place. Every language is learned."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.md5(F.concat(F.lit("lang|"), "text")).alias("hash"))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return Field([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    languages = sorted(r["lang"] for r in counts)
    sample_docs = min(sample_docs, max(20, sample_all // len(languages)))
    # twice the wanted share by hash, so that few rows are sorted; a language of few rows is taken whole
    shares = [(r["lang"], min(1.0, (2.0 * sample_docs + 50) / r["count"])) for r in counts]
    bound = F.broadcast(labelled.sparkSession.createDataFrame(shares, "lang string, share double"))
    below = F.conv(F.substring("hash", 1, 8), 16, 10).cast("bigint") / F.lit(float(16**8)) < F.col("share")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for text, digest in zip(frame["text"], frame["hash"]):
                words, place = _words(text), int(digest[8:16], 16)
                at = place % max(1, len(words) - sample_words + 1)
                # a long word, as in text without spaces, is read from a place of its own
                tails = [place % max(1, len(w) - sample_signs + 1) for w in words[at : at + sample_words]]
                found.append([w[t : t + sample_signs] for w, t in zip(words[at : at + sample_words], tails)])
            yield pd.DataFrame({"lang": frame["lang"], "hash": frame["hash"], "words": found})

    # texts are cut before they are shuffled; copies of a text count once
    drawn = rows.join(bound, "lang").where(below).select("lang", "hash", "text").mapInPandas(cut, "lang string, hash string, words array<string>")
    drawn = drawn.groupBy("lang", "hash").agg(F.first("words").alias("words"))

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values("hash").head(sample_docs)[["lang", "words"]]

    sample = drawn.groupBy("lang").applyInPandas(first, "lang string, words array<string>").toPandas()
    number = {name: i for i, name in enumerate(languages)}
    taught = sorted((list(w), number[l]) for w, l in zip(sample["words"], sample["lang"]) if len(w))
    return train(taught, languages) if taught else Field([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)))


def identify(docs: DataFrame, field: Field, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text_column, slice_bytes(len(model.languages))):
                names, score = model.predict(part.column(text_column))
                columns = [part.column(k) for k in keep] + [pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    rows = docs.select(*dict.fromkeys([*keep, text_column]))
    schema = StructType([*(rows.schema[k] for k in keep), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema)


def label_words(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, place, word, lang, score): the language of every word with letters, for text that switches languages."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text_column, slice_bytes(len(model.languages)) // 2):
                words, starts, lettered, found = model.label(part.column(text_column))
                sizes = np.diff(np.append(starts, len(words)))
                owner = np.repeat(np.arange(part.num_rows), sizes)
                place = np.arange(len(words)) - np.repeat(starts, sizes)
                at = np.flatnonzero(lettered)
                best = found[at].argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(id_column).take(pa.array(owner[at])),
                        pa.array(place[at].astype(np.int32)),
                        words.take(pa.array(at)),
                        pa.array([model.languages[b] for b in best], pa.string()),
                        pa.array(found[at, best]),
                    ],
                    names=[id_column, "place", "word", "lang", "score"],
                )

    rows = docs.select(id_column, text_column)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_column} {kind}, place int, word string, lang string, score double")


def op1_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = fit(docs.where(~held_out()).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), field, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
