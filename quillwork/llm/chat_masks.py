"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole, a turn after the other, and encoded once with the
tokenizer's offsets. The turns' spans and the tokens' spans are both sorted, so binary
search finds the tokens that touch an assistant's text; the mask is on these tokens, and the
loss ranges are their characters inside the text. Control strings inside roles and
texts are escaped with backslashes, so a rendered text can be read back exactly.

A very long conversation is rendered and encoded in chunks of consecutive turns, each
a row, cut at turn marks. Rows that cannot be told apart by their turn's number, as where turns are
null or all the same, are a crowd once there are many: equal rows of it are counted, the others put in order over all
tasks, and cut into pieces by their place. Only a conversation's digests need its rows one after the other, and they are
streamed, so no conversation has to fit in memory.

Defined results: a null text or role is empty; rows are ordered by turn, then role,
then text, null first; repeated rows are turns of their own; a null conv_id is a
conversation; an empty table gives no rows; further columns of whatever name are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.llm.common import table
from quillwork.session import materialise

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CHUNK_TURNS = 256
#: Rows of one conversation and chunk that are still put in order by one task, and rows of a task that orders a crowd.
CROWD, RUN = 4_096, 1 << 16
#: Characters of a text by which a crowd is dealt over tasks.
PREFIX = 256
LOSS_ROLE = "assistant"
HEAD, NAMED, TAIL = "### ", ":\n", "\n</turn>\n"
CONTROL = re.compile(r"\\|###|</turn>")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
HEADER = re.compile(r"### ((?:\\.|[^\\:])*):\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The rendered turns, and where the texts of the role that is learned from stand."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = HEAD + ROLE_CONTROL.sub(r"\\\g<0>", role) + NAMED
        body = escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, TAIL]
        at += len(head) + len(body) + len(TAIL)
    return "".join(parts), spans


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a rendered text. A turn's end mark never stands in a text without its backslash."""
    at = 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        end = formatted.index(TAIL, head.end() - 1) if formatted.startswith(TAIL, head.end() - 1) else formatted.index(TAIL, head.end())
        yield unescape(head[1]), unescape(formatted[head.end() : end])
        at = max(end, head.end()) + len(TAIL)


def align(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens touch a span, and the characters of each span that its tokens cover."""
    mask, covered = np.zeros(len(starts), bool), []
    if not spans or not len(starts):
        return mask, covered
    begin, end = np.array(spans).T
    first = np.searchsorted(ends, begin, side="right")
    last = np.searchsorted(starts, end, side="left")
    for b, e, i, j in zip(begin.tolist(), end.tolist(), first.tolist(), last.tolist()):
        if b < e and i < j:
            mask[i:j] = True
            for s, t in zip(np.maximum(starts[i:j], b).tolist(), np.minimum(ends[i:j], e).tolist()):
                if covered and covered[-1][0] >= b and s <= covered[-1][1]:
                    covered[-1] = covered[-1][0], max(covered[-1][1], t)
                else:
                    covered.append((s, t))
    return mask, covered


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def pieces(conversations: DataFrame, chunk_turns: int = CHUNK_TURNS, crowd: int = CROWD) -> DataFrame:
    """(conv_id, chunk, piece, rows): the turns in order, at most ``chunk_turns`` a row; chunks and pieces number them."""
    key = ["conv_id", "chunk"]
    rows = conversations.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-(2**62))).cast("long").alias("chunk"),
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("row"),
    )
    counts = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    crowds = materialise(counts, "crowds")
    total = crowds.agg(F.sum("n")).first()[0]
    plain = rows
    if total:
        # a crowd has more than CROWD rows, so there are fewer crowds than rows / CROWD
        hot = F.broadcast(crowds.select(*key))
        plain = rows.join(hot, same(rows, hot, key), "left_anti")
    listed = plain.groupBy(*key).agg(F.sort_array(F.collect_list("row")).alias("all"))
    starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(chunk_turns))
    listed = listed.select(*key, "all", F.posexplode(starts).alias("piece", "start"))
    found = listed.select(*key, F.col("piece").cast("long").alias("piece"), F.slice("all", F.col("start") + 1, chunk_turns).alias("rows"))
    if not total:
        return found
    # equal rows count once; the rest is dealt by ranges, so that a task's rows come before the next one's
    distinct = rows.join(hot, same(rows, hot, key), "left_semi").groupBy(*key, "row").agg(F.count("*").alias("n"))
    order = [*key, F.col("row.turn"), F.col("row.role"), F.substring("row.text", 1, PREFIX)]
    dealt = materialise(distinct.repartitionByRange(int(total // RUN) + 1, *order).withColumn("run", F.spark_partition_id()), "runs")
    behind = Window.partitionBy(*key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy(*key, "run").agg(F.sum("n").alias("n")).select(*key, "run", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*key, "run").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = dealt.withColumn("upto", F.sum("n").over(inside))
    # runs times crowds that meet there: fewer than runs + crowds
    known = F.broadcast(before)
    placed = numbered.join(known, same(numbered, known, [*key, "run"])).select(
        *[numbered[c] for c in key], "row", (F.col("before") + F.col("upto") - F.col("n")).alias("begin"), (F.col("before") + F.col("upto")).alias("end")
    )
    piece = F.explode(F.sequence(F.expr(f"begin div {chunk_turns}"), F.expr(f"(end - 1) div {chunk_turns}"))).alias("piece")
    cut = placed.select(*key, "row", "begin", "end", piece)
    copies = F.least("end", (F.col("piece") + 1) * chunk_turns) - F.greatest("begin", F.col("piece") * chunk_turns)
    ordered = F.sort_array(F.collect_list(F.struct("begin", "row", copies.cast("int").alias("copies"))))
    crowded = cut.groupBy(*key, "piece").agg(ordered.alias("all"))
    spread = F.flatten(F.transform("all", lambda x: F.array_repeat(x["row"], x["copies"])))
    return found.unionByName(crowded.select(*key, "piece", spread.alias("rows")))


def format_conversations(
    conversations: DataFrame, tokenizer: str = TOKENIZER, chunk_turns: int = CHUNK_TURNS, loss_role: str = LOSS_ROLE, crowd: int = CROWD
) -> DataFrame:
    """(conv_id, chunk, piece, formatted, ids, starts, ends, mask, loss): one row per conversation, or per piece of a long one.

    starts and ends are the tokens' code points in ``formatted``, mask is true for tokens to learn from, and
    loss has the ranges (s, e) of ``formatted`` that are learned from.
    """
    groups = pieces(conversations, chunk_turns, crowd)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                drawn = [render([(r["role"], r["text"]) for r in rows], loss_role) for rows in part.column("rows").to_pylist()]
                found = encoder.encode_batch([text for text, _ in drawn], add_special_tokens=False)
                out = {k: [] for k in ("ids", "starts", "ends", "mask", "loss")}
                for (_, spans), tokens in zip(drawn, found):
                    offsets = np.array(tokens.offsets, np.int32).reshape(-1, 2)
                    mask, covered = align(offsets[:, 0], offsets[:, 1], spans)
                    for k, v in zip(out, (np.array(tokens.ids, np.int32), offsets[:, 0], offsets[:, 1], mask)):
                        out[k].append(v)
                    out["loss"].append([{"s": s, "e": e} for s, e in covered])
                numbers = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("conv_id"),
                        part.column("chunk"),
                        part.column("piece"),
                        pa.array([text for text, _ in drawn], pa.string()),
                        *(pa.array(out[k], numbers) for k in ("ids", "starts", "ends")),
                        pa.array(out["mask"], pa.list_(pa.bool_())),
                        pa.array(out["loss"], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                    ],
                    names=["conv_id", "chunk", "piece", "formatted", *out],
                )

    kind = groups.schema["conv_id"].dataType.simpleString()
    return groups.mapInArrow(
        run,
        f"conv_id {kind}, chunk long, piece long, formatted string, ids array<int>, starts array<int>, ends array<int>,"
        " mask array<boolean>, loss array<struct<s:int,e:int>>",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: one row per conversation.

    A digest of a whole conversation needs its chunks in order; they pass by one after another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[list] = []
        now: list | None = None

        def close() -> None:
            if now:
                done.append([now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]])

        for batch in batches:
            for conv_id, text, loss in zip(batch.column("conv_id").to_pylist(), batch.column("formatted"), batch.column("loss").to_pylist()):
                text = text.as_py()
                if now is None or now[0] != conv_id:
                    close()
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["s"] : span["e"]])
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(text)
            if done:
                yield _digest_rows(done, ids)
                done.clear()
        close()
        if done:
            yield _digest_rows(done, ids)

    ids = pa.int64() if formatted.schema["conv_id"].dataType.simpleString() == "bigint" else pa.string()
    rows = formatted.select("conv_id", "chunk", "piece", "formatted", "loss")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "piece").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digest_rows(rows: list[list], ids: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def op10_chat_masks(spark, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").unionByName(extra)
    return digests(materialise(format_conversations(rows), "chat"))
