import random
import re
import textwrap
import time

import pytest

from quillwork.llm import licenses as lc


@pytest.fixture(scope="module")
def scanner():
    return lc.Scanner()


@pytest.mark.parametrize("key", lc.TEMPLATES)
def test_every_template_finds_itself(scanner, key):
    text = lc.TEMPLATES[key]
    for said in (text, text.upper(), "Some project. " + re.sub(" ", "\n * ", text), "foo bar baz " * 3 + text + " and more words here"):
        (found,) = scanner.scan(said)
        assert (found.license, found.form) == key and not found.missing and not found.added


@pytest.mark.parametrize(
    ("text", "license"),
    [
        ("Licensed under the Apache License, Version 1.1.", None),
        ("This work is licensed under the GNU General Public License, version 4.", None),
        ("This work is not licensed under the GNU General Public License, version 3.", None),
        ("Licensed under CC BY-NC 3.0.", None),
        ("Released under the terms of the MIT License.", None),
        ("We have the permission to walk, and copyright is a word.", None),
        (lc.TEMPLATES["MIT", "grant"].replace("free of charge", "gratis").replace("deal in", "deal with"), "MIT"),
        (lc.TEMPLATES["GPL-3.0", "notice"].replace("version 3", "version 2"), "GPL-2.0"),
    ],
)
def test_wording_decides(scanner, text, license):
    assert [f.license for f in scanner.scan(text)] == [license]


def test_rows(spark, sf_dir):
    notice = lc.TEMPLATES["MIT", "grant"]
    wrapped = "\n".join(textwrap.wrap(notice, 70))
    rows = [(1, None), (2, ""), (3, f"prose\n{wrapped}\nprose\nprose\nprose\nLicensed under CC BY-NC 4.0.\n"), (None, "Released under the MIT License."),
            (None, "Released under the MIT License."), (4, "license " * 30_000), (5, "a\r\nüß Licensed under CC BY-NC 4.0.\x85b")]
    df = spark.createDataFrame([(*r, "MIT") for r in rows], "doc_id long, text string, license string")
    got = sorted(((r["doc_id"], r["license"], r["form"]) for r in lc.scan_licenses(df).collect()), key=str)
    assert got == sorted([(3, "MIT", "grant"), (3, "CC-BY-NC-4.0", "name"), (None, "MIT", "name"), (None, "MIT", "name"), (4, None, None),
                          (5, "CC-BY-NC-4.0", "name")], key=str)
    assert lc.scan_licenses(df.limit(0)).count() == 0
    # against a plain search of the notices that the tables hold
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {(r["doc_id"], r["license"]) for r in lc.op4_license_scan(spark, sf_dir).collect()}
    names = [("MIT", "name"), ("Apache-2.0", "name"), ("GPL-3.0", "name"), ("CC-BY-NC-4.0", "name")]
    assert found == {(i, key[0]) for i, t in texts.items() for key in names if lc.TEMPLATES[key] in t}


def prose(size, seed):
    """Random plain words, many of which long templates hold too."""
    rng = random.Random(seed)
    common = sorted({w for text in lc.TEMPLATES.values() for w in lc.words_of(text) if w.isalpha() and w not in lc.NAMES and not lc.TRIGGERS.search(w)})
    own = ["".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(1500)]
    return [rng.choice(common if rng.random() < 0.5 else own) for _ in range(size)]


@pytest.mark.parametrize("key", lc.TEMPLATES)
@pytest.mark.parametrize("size", [400, 1000, 1900, 5000])
def test_notices_in_long_lines(scanner, key, size):
    words = prose(size, size)
    text = " ".join([*words[: size // 3], lc.TEMPLATES[key], *words[size // 3 :]])
    assert [(f.license, f.form) for f in scanner.scan(text)] == [key]


@pytest.mark.parametrize(
    ("text", "licenses"),
    [
        ("Licensed under the MIT License.", ["MIT"]),
        ("Released under the terms of the MIT License.", ["MIT"]),
        ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]),
        ("// SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]),
        ("License: ISC", ["ISC"]),
        ("This file is distributed under the GPLv3.", ["GPL-3.0"]),
        ("Available under the GNU Lesser General Public License v2.1 or later.", ["LGPL-2.1"]),
        ("Published under CC0 1.0.", ["CC0-1.0"]),
        ("shared under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 license", ["CC-BY-NC-SA-4.0"]),
        ("Made available under the Eclipse Public License 2.0.", ["EPL-2.0"]),
        ("Distributed under the zlib license.", ["Zlib"]),
        ("Distributed under the 2-clause BSD license.", ["BSD-2-Clause"]),
        ("You may not sell it. Licensed under the MIT License.", ["MIT"]),
        ("This work is not licensed under the MIT License.", [None]),
        ("Licensed under the Apache License, Version 1.1.", [None]),
        ("This work is licensed under the GNU General Public License, version 4.", [None]),
        ("Licensed under CC BY-NC 3.0.", [None]),
        ("The MIT License is short, and copyright is a word.", [None]),
    ],
)
def test_names_decide(scanner, text, licenses):
    assert [f.license for f in lc.licenses_of(scanner, text)] == licenses
    assert re.search(lc.TRIGGER, text)


def brute(scanner, words):
    """Every template in every window, ranked by what it saves in the whole block; no template is left out beforehand."""
    if len(words) < 3:
        return []
    alone = len(scanner.alone.compress(" ".join(words).encode()))
    saved = {key: len(scanner.given[key].compress(" ".join(words).encode())) for key in scanner.words}
    for key in sorted(scanner.words, key=saved.get):
        size = len(scanner.words[key])
        width, slack = size + max(1, int(lc.ADDED * size)), int(lc.MISSING * size)
        for begin in range(max(1, len(words) - size + slack + 1)):
            if found := scanner.confirmed(words, key, max(0, begin - slack), min(len(words), begin + width + slack)):
                return [*brute(scanner, words[: found[2]]), (*key, round(1 - saved[key] / alone, 4)), *brute(scanner, words[found[3] :])]
    return []


def test_query_against_all_templates_in_all_windows(spark, sf_dir, scanner):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want, blocks = [], {}
    for r in texts:
        for start, end in lc.blocks_of(r["text"] or ""):
            block = r["text"][start:end]
            if block not in blocks:
                confirmed = list(dict.fromkeys(brute(scanner, lc.words_of(block))))
                have = {f[0] for f in confirmed}
                blocks[block] = confirmed + [(f.license, "name", round(f.reduction, 4)) for f in scanner.named(block) if f.license not in have]
            want += [(r["doc_id"], start, end, *f) for f in blocks[block] or [(None, None, 0.0)]]
    got = [tuple(r)[:6] for r in lc.op4_license_scan(spark, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(g[3] for g in got)


def test_notices_in_one_block_against_all_windows(scanner):
    rng = random.Random(5)
    keys = list(lc.TEMPLATES)
    for _ in range(6):
        chosen = rng.sample(keys, 3)
        text = " ".join(x for k in chosen for x in (" ".join(prose(30, rng.random())), lc.TEMPLATES[k]))
        found = [(f.license, f.form) for f in scanner.scan(text)]
        assert found == list(dict.fromkeys(f[:2] for f in brute(scanner, lc.words_of(text)))) and set(found) == set(chosen)


def test_the_right_template_saves_most(scanner):
    for key, text in lc.TEMPLATES.items():
        words = lc.words_of(" ".join([*prose(60, 1), text, *prose(60, 2)]))
        first = scanner.ranked(words, scanner.words)[:4]
        # a template that holds another whole saves as much where only that one stands
        assert len(scanner.words[key]) < 20 or key in [k for k, _ in first] and first[0][1] > 0


def test_many_lines_take_time_in_proportion():
    begin = time.perf_counter()
    assert sum(1 for _ in lc.blocks_of("license\n\n\n\n\n\n\n" * 200_000)) == 200_000
    assert time.perf_counter() - begin < 20


def test_whole_texts_with_numbered_conditions(scanner):
    for license, last in (("BSD-2-Clause", 2), ("BSD-3-Clause", 3)):
        text = lc.TEMPLATES[license, "text"]
        for k, begin in enumerate(("Redistributions of", "Redistributions in", "Neither the name")[:last]):
            text = text.replace(begin, f"\n {k + 1}. {begin}")
        assert [(f.license, f.form) for f in scanner.scan(text)] == [(license, "text")]
    four = lc.TEMPLATES["BSD-2-Clause", "grant"] + " All advertising materials mentioning features must display the following acknowledgement."
    assert [f.license for f in scanner.scan(four)] == [None]
