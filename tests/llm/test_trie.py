import hashlib
import zlib
from collections import defaultdict

import pytest

from contrail.llm import prefix_trie as T
from llm_texts import words


def rebuilt(rows):
    """Turns of every conversation, the first ones taken from its family's first."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    out = {}
    for c, t in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        out[c] = (own.get(c - c % 20, [])[:h] if c is not None else []) + t[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    ids = lambda m: [c for c in m if c is not None]
    least = lambda m: min(ids(m), default=None)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def totals(node):
        own = (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0
        below = [totals(x) for x in children[node]]
        return (sum(x[0] for x in below) or 1), own + sum(x[1] for x in below)

    out = []
    for node, m in members.items():
        ends = sorted((c for c in m if len(convs[c]) == len(node)), key=lambda c: (c is not None, c or 0))
        leaves, saved = totals(node)
        out.append((least(m), len(node), least(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves, saved,
                    hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(turns):
    return sorted((tuple(r) for r in T.prefix_trie(T.share_first_turns(T.turn_sequences(turns))).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_hard_rows(spark):
    rows = []
    for c in range(0, 90):
        if c % 20 == 0 and c > 50:
            continue  # a family without its first conversation
        for t in range(c % 7 if c % 11 else 1):
            rows.append((c, t, ("user", "assistant", None)[t % 3], f"turn {t} of kind {c % 3}" + (" long" * 300 if c % 20 == 0 else "")))
    rows += [(200, None, "user", "null turn"), (200, 1, None, None), (200, 1, "a", "tie b"), (200, 1, "a", "tie a"), (201, 0, "user", ""), (201, 0, "user", ""),
             (None, 0, "user", "nobody"), (None, 1, "assistant", "answers"), (203, 0, "us", "er x"), (223, 0, "use", "r x")]
    df = frame(spark, rows)
    from pyspark.sql import functions as F
    clashing = df.select("*", *[F.lit("x").alias(c) for c in ("digests", "words", "chain", "depth", "node", "n", "h", "base", "lead", "first", "ids")])
    assert trie(clashing) == brute(rows)


def test_a_common_conversation_and_a_common_first_turn(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(1, 400) for t in range(4)] + [(1000 + c, t, "user", "same 0" if t < 1 else f"own {c} {t}") for c in range(100) for t in range(5)]
    assert trie(frame(spark, rows)) == brute(rows)


def test_many_chunks_of_a_common_end(spark, monkeypatch):
    rows = [(c, 0, "user", "hi") for c in range(1, 300)]
    monkeypatch.setattr(T, "CHUNK", 20)
    assert trie(frame(spark, rows)) == brute(rows)


def test_a_conversation_without_a_turn_left(spark):
    lone = next(c for c in range(20, 40) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    got = trie(frame(spark, [(lone, 0, "user", "a"), (lone, 1, "user", "b")]))
    assert got == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_deep_conversation(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(25)]
    assert trie(frame(spark, rows)) == brute(rows)


def test_empty_table(spark):
    out = T.prefix_trie(T.share_first_turns(T.turn_sequences(frame(spark, []))))
    assert out.count() == 0 and out.columns[0] == "conv_id"


@pytest.mark.parametrize("role,text", [("us", "er x"), ("use", "r x")])
def test_role_and_text_do_not_run_together(spark, role, text):
    one = T.turn_sequences(frame(spark, [(1, 0, role, text)])).first().digests
    other = T.turn_sequences(frame(spark, [(1, 0, "user", " x")])).first().digests
    assert one != other
