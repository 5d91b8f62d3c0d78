import hashlib
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillwork.llm import boosting, personal_data as pd_
from quillwork.llm.common import table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in ((2, CARD, 12, 19), (3, PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(digits[::-1])]
            if least <= len(digits) <= most and (kind == 3 or sum(double) % 10 == 0):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a.@-+0129 ()é%", max_size=60))
def test_base_patterns_on_any_text(text):
    assert pd_.base_spans(text) == plain(text)


def test_base_patterns_on_near_data():
    rng = random.Random(3)
    parts = ["a.b+c@x-y.org", "@", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.1.1.1", "4111 1111-1111 1111", "4111111111111111", "+1 (555) 555-0199", "+", " ", "é", "0", "-", ".", "x@y"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert pd_.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    begin = time.time()
    for text in ("a" * 10**6 + "@", "1" * 10**6, "1." * 10**6, "+1" + " (" * 10**6, "a@" * 10**6, "1 " * 10**6):
        pd_.base_spans(text)
        pd_.candidates(text[:200_000])
    assert time.time() - begin < 60


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) & (x[:, 1] > -0.5) | (x[:, 2] > 1)).astype(float)
    trees = boosting.BoostedTrees().fit(x[:2000], y[:2000])
    score = trees.score(x[2000:])
    assert ((score > 0) == (y[2000:] > 0)).mean() > 0.97
    steps, p = boosting.isotonic(score, y[2000:])
    assert (np.diff(p) >= 0).all() and (np.diff(steps) > 0).all()


def test_query_and_redaction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pd_.op7_personal_data(spark, sf_dir).collect():
        base = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(pd_.joined(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pd_.KINDS] == [sum(b[1] == k for b in base) for k in range(4)]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(pd_.joined(base).split(",")) - {""} <= set(spans)
    cleaned = {r["doc_id"]: r for r in pd_.redacted(docs).collect()}
    changed = 0
    for i, text in texts.items():
        assert plain(cleaned[i]["text"]) == [] and cleaned[i]["n_chars"] == len(cleaned[i]["text"])
        changed += cleaned[i]["text"] != text
        assert plain(text) or cleaned[i]["text"] == text or len(pd_.candidates(text)) > 0
    assert 0 < changed < len(texts)


def test_rows_that_are_odd(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "mail a@b.cd now", "x"), (None, "mail a@b.cd now", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = sorted(("-" if r["text"] is None else r["text"] for r in pd_.redacted(df).collect()))
    assert got == ["", "-", "mail [EMAIL] now", "mail [EMAIL] now"]
    assert pd_.redacted(df.limit(0)).count() == 0
    struct = df.select(pd_.find_spans(F.col("text"), pd_.SpanModel()).alias("f")).select("f.*").collect()
    assert sorted(r["spans"] for r in struct) == ["", "", "email:5:11", "email:5:11"]


def test_spans_beyond_the_base_patterns(spark):
    rng = random.Random(4)
    words = "the and river mill house garden bean child road evening spring rain field stone light table".split()

    def around(span):
        return " ".join([*rng.choices(words, k=8), span, *rng.choices(words, k=8)]) + "."

    def digits(n):
        return "".join(rng.choice("23456789") for _ in range(n))

    def card():
        first = "4" + digits(14)
        return next(first + c for c in "0123456789" if pd_.luhn(first + c))

    texts = []
    for _ in range(250):
        name = rng.choice(words) + digits(2)
        texts += [around(f"{name}@{rng.choice(words)}.{rng.choice(['com', 'org', 'net'])}"), around(".".join(str(rng.randrange(256)) for _ in range(4))),
                  around(card()), around(f"+1 ({digits(3)}) {digits(3)}-{digits(4)}"), around(digits(16))]
    model = pd_.fit(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    loose = {"jo (at) example (dot) com": 0, "ann.lee [at] mail [dot] org": 0, "(555) 123-4567": 3, "555-123-4567": 3, "555.867.5309": 3, "10[.]20[.]30[.]41": 1,
             "4111.1111.1111.1111": 2, "4111_1111_1111_1111": 2}
    placed = [around(x) for x in loose]
    assert not any(map(pd_.base_spans, placed))
    got = [[(t[s:e], k) for s, k, e in spans] for t, spans in zip(placed, model.select(placed))]
    assert got == [[x] for x in loose.items()]
    clean = ["2019-04-12", "12.04.2019", "04/12/2019", "12,345,678,901", "4111.1111.1111.1112", "4111111111111112", "3 @ 4.50", "12 34 56", "300[.]20[.]30[.]41", "no digits"]
    clean = [around(x) for x in clean]
    assert model.select(clean) == [[] for _ in clean]


def test_covered_places_are_those_of_all_spans():
    rng = np.random.default_rng(3)
    for _ in range(200):
        spans = [(int(b), 0, int(b + n)) for b, n in zip(rng.integers(0, 60, 8), rng.integers(1, 9, 8))]
        covered = pd_.Covered(spans)
        for begin in range(60):
            for end in (begin + 1, begin + 7):
                assert covered.touches(begin, end) == any(begin < e and s < end for s, _, e in spans)
        free = next((b for b in range(70) if not covered.touches(b, b + 2)), None)
        covered.add(free, free + 2)
        assert covered.touches(free, free + 1) and covered.begins == sorted(covered.begins)


def test_many_spans_in_one_text_take_time_in_proportion(spark, sf_dir):
    model = pd_.fit(table(spark, sf_dir, "documents"))
    text = " ".join(f"name{k}@mail{k}.example.com call 555 {k:04}" for k in range(20_000))
    begin = time.perf_counter()
    (spans,) = model.select([text])
    assert sum(pd_.KINDS[s[1]] == "email" for s in spans) == 20_000 and time.perf_counter() - begin < 60


#: Forms that ``variants`` does not write, by kind; (left, right) of an email, digits of the rest.
UNSEEN = {
    "email": [lambda a, b: f"{a}(at){b}", lambda a, b: f"{a} at {b.replace('.', ' dot ')}", lambda a, b: f"{a}{{at}}{b.replace('.', '{dot}')}",
              lambda a, b: f"{a} {{at}} {b}", lambda a, b: f"{a} [AT] {b.replace('.', ' [DOT] ')}", lambda a, b: f"{a}<at>{b}"],
    "ip": [lambda p: " . ".join(p), lambda p: "{.}".join(p), lambda p: " dot ".join(p), lambda p: "(dot)".join(p), lambda p: " [.] ".join(p)],
    "card": [lambda c: "  ".join(c), lambda c: "--".join(c), lambda c: " - ".join(c), lambda c: ". ".join(c)],
    "phone": [lambda a, b, c: f"0{a} {b}{c}", lambda a, b, c: f"({a})-{b}-{c}", lambda a, b, c: f"0{a} {b}-{c}", lambda a, b, c: f"{a} {b}.{c}"],
}


def unseen_forms(rng, n):
    """(kind, span) of spans in forms that the trees were not taught."""
    digits = lambda k: "".join(rng.choice("23456789") for _ in range(k))
    for _ in range(n):
        name, domain = rng.choice(["jo", "ann.lee", "m_ray7", "info"]), rng.choice(["example.com", "mail.example.org", "site-x.net"])
        for form in UNSEEN["email"]:
            yield 0, form(name, domain)
        for form in UNSEEN["ip"]:
            yield 1, form([str(rng.randrange(256)) for _ in range(4)])
        first = "4" + digits(14)
        card = next(first + c for c in "0123456789" if pd_.luhn(first + c))
        for form in UNSEEN["card"]:
            yield 2, form([card[k : k + 4] for k in range(0, 16, 4)])
        for form in UNSEEN["phone"]:
            yield 3, form(digits(3), digits(3), digits(4))


def test_forms_that_were_not_taught(spark):
    """Recall by kind on forms and texts that the trees have not seen, and clean text beside them."""
    rng = random.Random(11)
    words = "the and river mill house garden bean child road evening spring rain field stone light table".split()
    around = lambda span: " ".join([*rng.choices(words, k=8), span, *rng.choices(words, k=8)]) + "."
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = pd_.fit(docs)
    hit, total = [0] * 4, [0] * 4
    for kind, span in unseen_forms(rng, 40):
        text = around(span)
        if pd_.base_spans(text):
            continue
        (spans,) = model.select([text])
        total[kind] += 1
        hit[kind] += any(k == kind and text[s:e] == span for s, k, e in spans)
    print("recall on unseen forms", [f"{k} {h} of {t}" for k, h, t in zip(pd_.KINDS, hit, total)])
    assert all(h >= 0.9 * t for h, t in zip(hit, total)) and min(total) > 100
    clean = ["look at example.com", "3 @ 4.50", "5 at 3 dot 7", "1 , 2 , 3 , 4", "300 . 20 . 30 . 41", "4111  1111  1111  1112", "2019-04-12", "pages 120 - 135", "2019 2020 2021 2022"]
    assert model.select([around(x) for x in clean]) == [[] for _ in clean]


def test_texts_anywhere_in_a_table_teach(spark):
    """Thousands of documents that teach nothing and come first by their hash leave what the others teach as it is."""
    rng = random.Random(6)
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    spans = [lambda: f"mail ann{rng.randrange(10**6)}@example.org now", lambda: f"call +1 ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(2000, 9999)} now"]
    teaching = [t for t in (rng.choice(spans)() for _ in range(600)) if digest(t) >= "8"]
    idle = [t for t in (f"page {k}" for k in range(10_000)) if digest(t) < "8"]
    assert len(idle) > 4000
    few, many = (pd_.fit(spark.createDataFrame([(t,) for t in texts], "text string")) for texts in (teaching, idle + teaching + teaching[:9]))
    asked = ["mail jo (at) example (dot) com now", "call (555) 123-4567 now", "page 12"]
    assert many.select(asked) == few.select(asked) == [[(5, 0, 30)], [(5, 3, 19)], []]
    assert many.least == few.least and all(map(np.array_equal, many.trees.cuts, few.trees.cuts))


def test_every_example_counts(spark):
    """More examples than any bound there was, counted as a plain loop counts them."""
    rng = random.Random(8)
    texts = [f"call +{rng.randrange(10**9, 10**13)} or {rng.randrange(10**15, 10**16)}, {k}" for k in range(700)]
    counts, total = {}, 0
    for text in texts:
        order = int(hashlib.md5(text.encode()).hexdigest()[:12], 16)
        for label, x in pd_.examples(pd_.excerpts(text), random.Random(order)):
            counts.setdefault((order % 2, boosting.packed(x)), [0, 0])[label] += 1
            total += 1
    assert total > 20_000
    got = pd_.teaching(spark.createDataFrame([(t,) for t in texts * 2], "text string")).collect()
    assert {(r["fold"], bytes(r["x"])): [r["n0"], r["n1"]] for r in got} == counts and len(got) == len(counts)


def test_trees_of_a_table_are_those_of_its_rows(spark):
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 2, 9000), rng.integers(0, 300, 9000), rng.poisson(3, 9000), np.full(9000, 7)], axis=1)
    y = ((x[:, 1] > 120) ^ (rng.random(9000) < 0.1 * x[:, 0])).astype(float)
    cells = {}
    for row, label in zip(x.tolist(), y):
        cells.setdefault(tuple(row), [0, 0])[int(label)] += 1
    table_ = spark.createDataFrame([(0, boosting.packed(k), *n) for k, n in cells.items()], boosting.VECTORS)
    plain = boosting.BoostedTrees(rounds=4).fit(x, y)
    for parts in (1, 7):
        rows = table_.repartition(parts)
        trees = boosting.BoostedTrees(rounds=4).fit_table(rows, boosting.tallied(rows))
        assert all(map(np.array_equal, trees.cuts, plain.cuts)) and trees.base == plain.base
        assert all(np.array_equal(a, b) for one, other in zip(trees.trees, plain.trees) for a, b in zip(one, other))
    for k, cuts in enumerate(plain.cuts):
        assert cuts.tolist() == np.unique(np.quantile(x[:, k], np.linspace(0, 1, 33)[1:-1], method="lower")).tolist()
    label, weight = np.array([0.0, 1, 0, 1, 1]), np.array([3, 1, 2, 4, 0])
    score = np.array([0.1, 0.1, 0.2, 0.3, 0.2])
    once, many = boosting.isotonic(score, label, weight), boosting.isotonic(np.repeat(score, weight), np.repeat(label, weight))
    assert all(map(np.array_equal, once, many))
