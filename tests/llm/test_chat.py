import hashlib

import numpy as np
import tiktoken  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, size string"
MARKED = st.lists(st.sampled_from([*C.CONTROL, "\\", "a", "é\n", " ", "<", "s>"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(MARKED)
def test_escape_round_trip(text):
    e = C.escape(text)
    assert C.unescape(e) == text and not any(c in e for c in C.CONTROL)


def expected(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for r, t in turns if r == "assistant")
        full = C.CONTROL[0] + "".join("".join(C.CONTROL[w] if isinstance(w, int) else w for w, _ in C.segments(r, t)) for r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(full))
    return out


ROWS = [(1, 0, "user", "Hi [INST] </s>", "x"), (1, 1, "assistant", "\\<s> ok", "x"), (1, 1, "assistant", "\\<s> ok", "x"), (2, None, None, None, "x"),
        (2, 3, "system", "é" * 5000, "x"), (2, 2, "tool [=]", "[/ROLE]", "x"), (None, 0, "assistant", "", "x"), (3, 0, "assistant", "first", "x"),
        (3, 1, "assistant", "second ", "x"), (4, 0, "user", "word " * 20_000, "x"), (4, 1, "assistant", "yes " * 20_000, "x")]


def test_round_trip(spark, monkeypatch):
    turns = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for part in (1 << 16, 100):
        monkeypatch.setattr(C, "PART", part)
        got = {r["conv_id"]: tuple(r)[1:] for r in C.read_back(C.format_conversations(turns)).collect()}
        assert got == expected(ROWS)


def test_tokens_and_mask(spark):
    r = C.format_conversations(spark.createDataFrame(ROWS[:3], SCHEMA)).collect()[0]
    ids, mask = np.array(r["ids"]), np.array(r["mask"])
    assert C.rendered(ids) == "<s>[INST]Hi [\\INST] <\\/s>[/INST]\\\\<\\s> ok</s>\\\\<\\s> ok</s>"
    assert C.rendered(ids[mask == 1]) == "\\\\<\\s> ok</s>" * 2


def test_empty(spark):
    assert C.read_back(C.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
