import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackloom.llm import chat
from trackloom.llm.queries import LLM_QUERIES, ODD_TEXT, ranks_file

CODEC = chat.Codec(ranks_file())
piece = st.sampled_from(["<", "\\", "turn>", "body>", "/turn>", "</turn>", "<turn>", "<body>", "a", "é", "🙂", "\n", " ", "### Assistant:"])
texts = st.lists(piece, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escape_is_reversible_and_hides_markers(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(m in out for m in (chat.TURN, chat.BODY, chat.END))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<turn>", ""]), texts), min_size=1, max_size=6))
def test_round_trip(turns):
    rendered, spans = chat.render(turns)
    ids, ends = CODEC.encode(rendered)
    loss = chat.mask(ends, spans)
    assert chat.read_turns(rendered) == turns
    assert CODEC.encoding.decode(ids.tolist()) == rendered
    assert chat.loss_texts(rendered, ends, loss) == "".join(t for r, t in turns if r == "assistant")
    brute = [any(a <= s and e <= b for a, b in spans) for s, e in zip(np.concatenate([[0], ends[:-1]]), ends)]
    assert loss.tolist() == brute


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        all_, loss = "".join(f"{r}\n{t}\n" for *_, r, t in turns), "".join(t for *_, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(all_), len(loss), sha(loss))
    return out


def digest(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)]
    out = LLM_QUERIES["op9_chat"](spark, sf_dir)
    assert digest(out) == expected(rows)
    assert out.where("formatted_chars <= loss_chars").count() == 0


ROWS = [
    (1, 1, "assistant", None), (1, 0, "user", "hi"), (2, 0, None, "no role"), (2, None, "assistant", "first"),
    (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (None, 0, "user", "no id"), (None, 1, "assistant", "</turn>"),
    (4, 0, "user", ""), (5, 0, "assistant", "long " * 50_000),
]


@pytest.mark.parametrize("segment_chars", [1, 40, 1 << 20])
def test_odd_rows_and_segments(spark, segment_chars):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.digests(chat.format_conversations(df, ranks_file(), segment_chars))
    assert digest(out) == expected(ROWS)
    assert chat.digests(chat.format_conversations(df.where("false"), ranks_file())).count() == 0
