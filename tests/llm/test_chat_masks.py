import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quillwork.llm import chat_masks as cm

PIECES = st.lists(st.sampled_from(["\\", "###", "### ", "</turn>", "\n", ":", ":\n", "a", " ", "é", "漢", "😀", "\n</turn>\n", "assistant", "<|endoftext|>"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=5))
def test_round_trip(turns):
    text, spans = cm.render(turns)
    assert list(cm.read_back(text)) == turns
    said = [t for r, t in turns if r == "assistant"]
    assert [cm.unescape(text[s:e]) for s, e in spans] == said


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), PIECES | st.text(max_size=20)), max_size=5))
def test_masks_cover_assistant_texts_alone(turns):
    from tokenizers import Tokenizer
    import numpy as np

    encoder = Tokenizer.from_file(cm.TOKENIZER)
    encoder.encode_special_tokens = True
    turns = [(r, t.encode("utf-8", "ignore").decode()) for r, t in turns]
    text, spans = cm.render(turns)
    offsets = np.array(encoder.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
    mask, covered = cm.align(offsets[:, 0], offsets[:, 1], spans)
    assert "".join(text[s:e] for s, e in covered) == "".join(text[s:e] for s, e in spans)
    touched = [any(s < e and a < e and s < b for s, e in spans) for a, b in offsets]
    assert mask.tolist() == touched


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", None), (2, 5, None, "x"), (2, None, "assistant", "first"), (None, 1, "assistant", "n"),
            (3, 1, "assistant", "é</turn>"), (3, 1, "assistant", "é</turn>"), (4, 0, "system", "y" * 50_000)]
    rows += [(9, k, "assistant" if k % 2 else "user", f"turn {k} ###") for k in range(1500)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, chunk string").repartition(4)
    got = {r[0]: tuple(r)[1:5] for r in cm.digests(cm.format_conversations(df)).collect()}
    assert got == plain(rows)
    assert cm.digests(cm.format_conversations(df.limit(0))).count() == 0


def test_crowds_are_cut(spark):
    """Turns that are null, or all of one number, equal rows among them: no row of the result holds more than a chunk."""
    said = lambda k: ("assistant" if k % 3 else "user", f"turn {k * 7919 % 3000:04d} </turn>")
    rows = [(1, None, *said(k)) for k in range(3000)] + [(2, 5, *said(k)) for k in range(3000)]
    rows += [(3, 7, "assistant", "again")] * 2500 + [(3, 7, "user", "é" * 300 + str(k)) for k in range(40)]
    rows += [(None, None, None, None)] * 1100 + [(None, k, "user", "x") for k in range(600)] + [(4, 0, "user", "a"), (4, 1, "assistant", "b")]
    df = spark.createDataFrame([(*r, "r", 1) for r in rows], "conv_id long, turn long, role string, text string, row string, piece int").repartition(5)
    result = cm.format_conversations(df, chunk_turns=64, crowd=500)
    assert {r[0]: tuple(r)[1:5] for r in cm.digests(result).collect()} == plain(rows)
    held = cm.pieces(df, 64, 500).selectExpr("conv_id", "chunk", "piece", "size(rows) AS n").collect()
    assert max(r["n"] for r in held) <= 64 and sum(r["n"] for r in held) == len(rows)
    assert len({tuple(r)[:3] for r in held}) == len(held)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    result = cm.op10_chat_masks(spark, sf_dir).collect()
    assert {r[0]: tuple(r)[1:5] for r in result} == plain(rows)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in result)
