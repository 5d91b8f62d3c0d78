"""A prefix trie of conversations, by hashing blocks of turns.

Turns become digests, and blocks of a fixed number of turns become digests of these; a conversation is then a short list
of blocks. Conversations are grouped by the blocks they begin with. Where the conversations behind a prefix all go on with
the same block, its turns are nodes as they stand. Only where they go on with different blocks are
these, each once however many conversations hold it, taken apart into turns and grouped again.

A prefix has the exclusive or of the digests of its (place, turn) pairs as its name, so names of later
blocks come from sums over chunks of a conversation and a huge one needs no single task. Digests are keyed
anew for every call, so no text can be made to collide; two names of 128 bits are taken as equal only if the prefixes are.

What a subtree holds follows from numbers of its members. A node belongs to its smallest
member; so a conversation owns one unbroken path, from where it leaves smaller ones to its end. Sums over members of what
they own, corrected for the node's own first member, are sums over the subtree's nodes, whatever its depth.

Defined results: turns are ordered by turn, null first, turns of equal number by a digest of role and text; a null role or
text is empty; repeated rows are turns of their own; rows without a conversation id are left out; a conversation without turns is
a member of the root and ends there; an empty table gives no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.llm.common import table
from quillwork.operators.joins import lookup_join
from quillwork.session import materialise

BLOCK_TURNS = 8
#: Blocks of a conversation whose names are worked out together, and ids that are listed in one row.
CHUNK_BLOCKS, LISTED = 1024, 4096


def conversation_turns(conversations: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(conv_id, place, turn_a, turn_b, bytes): turns numbered from 0, texts as 128-bit digests and UTF-8 lengths.

    Rows are sorted by ranges, so a huge conversation lies in several; it is numbered inside each,
    and goes on from the counts of the ranges before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)

    def half(begin: int) -> Column:
        return F.xxhash64(F.substring(told, begin, 32))

    digests = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("conv_id"), "turn", half(1).alias("turn_a"), half(33).alias("turn_b"), F.octet_length(text).cast("long").alias("bytes")
    )
    rows = materialise(digests, "turns").withColumn("row", F.monotonically_increasing_id())
    order = [F.col("turn").asc_nulls_first(), F.col("turn_a"), F.col("turn_b"), F.col("row")]
    ranged = materialise(
        rows.repartitionByRange(F.col("conv_id"), *order).sortWithinPartitions(F.col("conv_id"), *order)
        .withColumn("range", F.spark_partition_id()), "ordered",
    )
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    offsets = counts.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).where("before > 0")
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order)) - 1
    return (
        ranged.withColumn("inside", inside).join(offsets, ["conv_id", "range"], "left")
        .select("conv_id", (F.col("inside") + F.coalesce("before", F.lit(0))).alias("place"), "turn_a", "turn_b", "bytes")
    )


def _blocks(turns: DataFrame, block_turns: int, key: int) -> DataFrame:
    """(conv_id, block, begin_a, begin_b, end_a, end_b, turns, before, bytes): blocks with the names of the prefixes they go from and to.

    turns is a list of (name part a, name part b, bytes) of at most ``block_turns`` turns; before is the bytes of all turns before.
    """
    parts = [F.xxhash64(F.lit(key + k), "place", "turn_a", "turn_b").alias(n) for k, n in enumerate("ab")]
    listed = F.sort_array(F.collect_list(F.struct("place", "a", "b", "bytes")))
    grouped = (
        turns.select("conv_id", "place", F.expr(f"place div {int(block_turns)}").alias("block"), *parts, "bytes")
        .groupBy("conv_id", "block")
        .agg(listed.alias("turns"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("bytes").alias("bytes"))
    )
    blocks = materialise(grouped.withColumn("chunk", F.expr(f"block div {CHUNK_BLOCKS}")), "blocks")
    sums = [F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("bytes").alias("bytes")]
    chunks = blocks.groupBy("conv_id", "chunk").agg(*sums)
    ahead = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = chunks.select(
        "conv_id", "chunk", *[F.coalesce(f(c).over(ahead), zero).alias(f"chunk_{c}") for f, c in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "bytes"))]
    )
    near = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocks.withColumns({f"near_{c}": F.coalesce(f(c).over(near), zero) for f, c in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "bytes"))})
        .join(carried.where("chunk > 0"), ["conv_id", "chunk"], "left")
        .withColumns({f"begin_{c}": F.col(f"near_{c}").bitwiseXOR(F.coalesce(f"chunk_{c}", zero)) for c in "ab"})
        .select(
            "conv_id", "block", "begin_a", "begin_b", *[F.col(f"begin_{c}").bitwiseXOR(F.col(c)).alias(f"end_{c}") for c in "ab"],
            "turns", (F.col("near_bytes") + F.coalesce("chunk_bytes", zero)).alias("before"), "bytes",
        )
    )


BEGIN, NAME, ABOVE = ["block", "begin_a", "begin_b"], ["depth", "a", "b"], ["depth_above", "above_a", "above_b"]


def _as_turns(blocks: DataFrame, sums: list[str]) -> DataFrame:
    """Every turn of each block as a node: name, name of the node above, bytes before and of its last turn."""
    zero = F.lit(0).cast("long")

    def named(upto: Column, start: str, part: str) -> Column:
        return F.aggregate(F.slice("turns", 1, upto), F.col(start), lambda x, t: x.bitwiseXOR(t[part]))

    at = F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("at")
    turn = F.element_at("turns", F.col("at"))
    return blocks.select("*", at).select(
        (turn["place"] + 1).alias("depth"),
        *[named(F.col("at"), f"begin_{c}", c).alias(c) for c in "ab"],
        turn["place"].alias("depth_above"),
        *[named(F.col("at") - 1, f"begin_{c}", c).alias(f"above_{c}") for c in "ab"],
        (F.col("before") + F.aggregate(F.slice("turns", 1, F.col("at") - 1), zero, lambda x, t: x + t["bytes"])).alias("before"),
        turn["bytes"].alias("bytes"),
        *sums,
    )


def _grouped_turns(block_nodes: DataFrame, aggregates: dict) -> DataFrame:
    """Block nodes to turn nodes: taken as they are behind prefixes that go on in one way, refined behind others.

    ``aggregates`` says how a column of several block nodes that share a turn is combined.
    """
    sums = list(aggregates)
    fields = ["end_a", "end_b", "turns", "before", *sums]
    ways = block_nodes.groupBy(*BEGIN).agg(F.count("*").alias("ways"), F.first(F.struct(*fields)).alias("only"))
    alone = ways.where("ways = 1").select(*BEGIN, "only.*")
    several = materialise(ways.where("ways > 1").select(*BEGIN), "branching")
    branching = lookup_join(block_nodes, several, BEGIN, spread=["end_a", "end_b"])
    refined = (
        _as_turns(branching, sums).groupBy(*NAME, *ABOVE, "before", "bytes")
        .agg(*[f(c).alias(c) for c, f in aggregates.items()])
    )
    return _as_turns(alone, sums).unionByName(refined)


def listed_digests(rows: DataFrame, keys: list[str], id_column: str = "conv_id") -> DataFrame:
    """SHA-256 of the ids of each key, ascending and comma-joined. A key's ids come in pieces and are streamed in order."""
    pieces = rows.groupBy(*keys, F.floor(F.col(id_column) / LISTED).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(id_column)), lambda x: x.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if key == now:
                    digest.update(b"," + ids.encode())
                else:
                    if digest:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
            yield emit(done)
            done = []
        if digest:
            yield emit([(*now, digest.hexdigest())])

    kinds = [pa.int64()] * len(keys) + [pa.string()]

    def emit(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names=[*keys, "ends_sha256"])

    sorted_pieces = pieces.select(*keys, "piece", "ids").repartition(*keys).sortWithinPartitions(*keys, "piece")
    return sorted_pieces.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, place, turn_a, turn_b, bytes), for the conversations in ``ids``.

    One row per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes of repeated texts in the subtree) and ends_sha256. A conversation in ``ids`` may have no turn.
    """
    key = secrets.randbelow(1 << 62)
    blocks = materialise(_blocks(turns, block_turns, key), "prefixes")
    zero = F.lit(0).cast("long")

    # what the conversations are as a whole: their length, the name of their last node, their bytes
    last = F.max(F.struct("block", (F.col("block") * block_turns + F.size("turns")).alias("depth"), F.col("end_a").alias("a"), F.col("end_b").alias("b"),
                          (F.col("before") + F.col("bytes")).alias("total"))).alias("last")
    whole = materialise(
        ids.select("conv_id").distinct().join(blocks.groupBy("conv_id").agg(last), "conv_id", "left")
        .select("conv_id", *[F.coalesce(f"last.{c}", zero).alias(c) for c in (*NAME, "total")]), "conversations",
    )

    # the nodes, with their members counted and added up
    members = {"n_convs": F.sum, "conv_id": F.min, "sum_total": F.sum}
    met = lookup_join(blocks, whole.select("conv_id", "total"), ["conv_id"], spread=["block"]).groupBy(*BEGIN, "end_a", "end_b").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("total").alias("sum_total"),
        F.first("turns").alias("turns"), F.first("before").alias("before"),
    )
    root = whole.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("total").alias("sum_total")).where("n_convs > 0").select(
        *[zero.alias(c) for c in NAME], *[F.lit(None).cast("long").alias(c) for c in ABOVE], zero.alias("before"), zero.alias("bytes"),
        "n_convs", "conv_id", "sum_total",
    )
    found = materialise(_grouped_turns(materialise(met, "block_nodes"), members).unionByName(root), "nodes")
    children = found.where("depth > 0").groupBy(*[F.col(x).alias(y) for x, y in zip(ABOVE, NAME)]).agg(F.count("*").alias("n_children"))
    nodes = materialise(found.join(children, NAME, "left").withColumn("n_children", F.coalesce("n_children", zero)), "counted")

    # what each conversation owns: the bytes of its path from its first own node on, and whether a leaf is its own
    owned = nodes.groupBy("conv_id").agg(
        F.min_by("before", "depth").alias("own_before"), F.max(F.struct("depth", (F.col("n_children") == 0).cast("long").alias("leaf"))).alias("end")
    )
    shares = materialise(
        whole.join(owned, "conv_id").select("conv_id", "total", (F.col("total") - F.col("own_before")).alias("own"), F.col("end.leaf").alias("leaf")), "shares"
    )

    # sums over members of what they own: again by blocks first; conversations that own nothing add nothing
    adding = lookup_join(blocks, shares.select("conv_id", "own", "leaf"), ["conv_id"], spread=["block"])
    owning = {"sum_own": F.sum, "n_leaves": F.sum}
    again = adding.groupBy(*BEGIN, "end_a", "end_b").agg(
        F.sum("own").alias("sum_own"), F.sum("leaf").alias("n_leaves"), F.first("turns").alias("turns"), F.first("before").alias("before")
    )
    root_sums = shares.agg(F.sum("own").alias("sum_own"), F.sum("leaf").alias("n_leaves")).where("sum_own IS NOT NULL")
    sums = (
        _grouped_turns(materialise(again, "owned_blocks"), owning).select(*NAME, *owning)
        .unionByName(root_sums.select(*[zero.alias(c) for c in NAME], *owning))
    )

    ends = listed_digests(whole.select(*NAME, "conv_id"), NAME)
    firsts = shares.select("conv_id", F.col("total").alias("first_total"), F.col("own").alias("first_own"))
    known = nodes.join(sums, NAME).join(ends, NAME, "left")
    known = lookup_join(known, firsts, ["conv_id"], spread=["depth"])
    above = nodes.select(*[F.col(x).alias(y) for x, y in zip(NAME, ABOVE)], F.col("conv_id").alias("parent_conv_id")).where("n_children > 0")
    known = lookup_join(known, above, ABOVE, spread=NAME, how="left")
    members_bytes = F.col("sum_total") - F.col("n_convs") * F.col("before")
    distinct_bytes = F.col("sum_own") - F.col("first_own") + F.col("first_total") - F.col("before")
    return known.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (members_bytes - distinct_bytes).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


FAMILY, MOST_BORROWED = 5, 9


def rebuilt(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation with the first turns of its family's first one in place of its own first ones.

    Conversation c takes the first h = crc32(c) mod 9 turns of c - c mod 5, and keeps its own turns after its first h.
    A family's first conversation has at most eight rows to give, to five conversations.
    """
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED).alias("h")
    heads = turns.where(F.col("place") < MOST_BORROWED - 1).select(F.col("conv_id").alias("base"), "place", "turn_a", "turn_b", "bytes")
    asking = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), borrowed)
    taken = materialise(asking.join(heads, "base").where("place < h").select("conv_id", "place", "turn_a", "turn_b", "bytes"), "heads")
    # a conversation whose base is short or absent has its own turns moved down
    short = (
        asking.join(taken.groupBy("conv_id").agg(F.count("*").alias("got")), "conv_id", "left")
        .select("conv_id", (F.col("h") - F.coalesce("got", F.lit(0))).alias("missing")).where("missing > 0")
    )
    own = turns.withColumn("h", borrowed).where("place >= h")
    moved = lookup_join(own, materialise(short, "short"), ["conv_id"], spread=["place"], how="left")
    kept = moved.select("conv_id", (F.col("place") - F.coalesce("missing", F.lit(0))).cast("long").alias("place"), "turn_a", "turn_b", "bytes")
    return taken.select("conv_id", F.col("place").cast("long").alias("place"), "turn_a", "turn_b", "bytes").unionByName(kept)


def family_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns = materialise(conversation_turns(conversations), "numbered")
    ids = materialise(turns.select("conv_id").distinct(), "ids")
    return prefix_trie(rebuilt(turns, ids), ids)


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return family_trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL = """
WITH RECURSIVE steps AS (
    SELECT list(c ORDER BY i) AS steps FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
        FROM range(256) r(i))
), ids AS (
    SELECT conv_id, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                        lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), steps
), ordered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || ':' || coalesce(text, ''))) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), joined AS (
    SELECT i.conv_id, 0 AS part, o.place, o.role, o.text FROM ids i JOIN ordered o ON o.conv_id = i.conv_id - i.conv_id % 5 AND o.place < i.h
    UNION ALL SELECT o.conv_id, 1, o.place, o.role, o.text FROM ids i JOIN ordered o ON o.conv_id = i.conv_id AND o.place >= i.h
), turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth,
           sha256(length(role) || ':' || role || text) AS name, octet_length(encode(text)) AS bytes
    FROM joined
), paths AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM ids
    UNION ALL SELECT p.conv_id, t.depth, sha256(p.path || t.name), t.bytes FROM paths p JOIN turns t ON t.conv_id = p.conv_id AND t.depth = p.depth + 1
), nodes AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY depth, path
), lengths AS (
    SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), links AS (
    SELECT n.depth, n.path, p.path AS parent, m.conv_id AS parent_conv_id
    FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN nodes m ON m.depth = p.depth AND m.path = p.path
), children AS (
    SELECT depth - 1 AS depth, parent AS path, count(*) AS n FROM links GROUP BY ALL
), subtrees AS (
    SELECT p.depth, p.path, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
    FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
    GROUP BY ALL
), ends AS (
    SELECT depth, path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM lengths JOIN paths USING (conv_id, depth) GROUP BY ALL
)
SELECT n.conv_id, n.depth::BIGINT AS depth, l.parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN links l USING (depth, path) LEFT JOIN children c USING (depth, path) JOIN subtrees s USING (depth, path) LEFT JOIN ends e USING (depth, path)
"""
