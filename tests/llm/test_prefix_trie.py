import hashlib
import math
from collections import defaultdict
from functools import partial
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.llm import prefix_trie as pt
from quillwork.operators.joins import SizeBound, lookup_join


def nodes_of(paths):
    """The trie of {conv_id: [(role, text), ...]}, by every prefix of every conversation."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, held in members.items()
    )


def own_turns(rows):
    found = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            found[c].append((role or "", text or ""))
    return found


def rebuilt(rows):
    own, out = own_turns(rows), {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def some_rows(seed=1):
    rng = np.random.default_rng(seed)
    stems = [[("user" if k % 2 else "system", f"stem {s} {k} é") for k in range(20)] for s in range(4)]
    rows = []
    for c in range(-7, 60):
        stem = stems[rng.integers(0, 4)][: rng.integers(0, 20)]
        tail = [("user", f"tail {rng.integers(0, 3)}") for _ in range(rng.integers(0, 6))]
        rows += [(c, k, *turn) for k, turn in enumerate(stem + tail)]
    rows += [(c, k, *stems[0][k]) for c in range(100, 140) for k in range(13)]  # equal conversations
    rows += [(200, k, "user", "again" if k % 7 else None) for k in range(700)]  # a long one
    rows += [(201, None, None, None), (201, None, None, None), (201, 5, "user", ""), (201, 5, "user", ""), (None, 1, "user", "lost"), (205, 0, "a", "")]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({"place": F.lit("clash"), "block": F.lit(1), "depth": F.lit(2), "row": F.lit(3)}).repartition(4)


def trie(df, block_turns):
    turns = pt.conversation_turns(df)
    return sorted(map(tuple, pt.prefix_trie(turns, turns.select("conv_id").distinct(), block_turns).collect()))


@pytest.mark.parametrize("block_turns", [1, 3, 8])
def test_trie_against_all_prefixes(spark, monkeypatch, block_turns):
    monkeypatch.setattr(pt, "CHUNK_BLOCKS", 4)
    monkeypatch.setattr(pt, "LISTED", 8)
    rows = some_rows()
    assert trie(frame(spark, rows), block_turns) == nodes_of(own_turns(rows))


def test_rebuilt_conversations_and_large_lookups(spark, monkeypatch):
    rows = some_rows(2)
    assert sorted(map(tuple, pt.family_trie(frame(spark, rows)).collect())) == nodes_of(rebuilt(rows))
    monkeypatch.setattr(pt, "lookup_join", partial(lookup_join, bound=SizeBound(0, 0)))
    assert sorted(map(tuple, pt.family_trie(frame(spark, rows)).collect())) == nodes_of(rebuilt(rows))


def test_turnless_members_and_empty_tables(spark):
    rows = [(0, 0, "user", "a"), (3, 0, "user", "b")]
    turns = pt.conversation_turns(frame(spark, rows))
    ids = spark.createDataFrame([(0,), (3,), (9,), (9,)], "conv_id long")
    found = sorted(map(tuple, pt.prefix_trie(turns, ids).collect()))
    assert found == nodes_of({0: [("user", "a")], 3: [("user", "b")], 9: []})
    assert pt.family_trie(frame(spark, rows).limit(0)).collect() == []


def test_order_of_equal_turn_numbers_is_that_of_no_partition(spark):
    rows = [(c, 1, "user", f"text {k}") for c in (1, 2, 3) for k in range(9)]
    one = trie(frame(spark, rows), 4)
    assert one == trie(frame(spark, rows[::-1]).repartition(1), 4) and len(one) == 10
