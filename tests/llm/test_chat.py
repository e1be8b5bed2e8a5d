"""Snapshots collapsed beside a comparison of all conversations with each other."""

import random

import pytest

from stopgrid.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        talks.setdefault(conv, []).append((turn is None, turn or 0, role or "unknown", text or ""))
    talks = {c: [t[2:] for t in sorted(turns)] for c, turns in talks.items()}
    out = []
    for conv, turns in talks.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in talks.values()):
            continue
        same = [c for c, o in talks.items() if o == turns]
        if conv != min(same, key=lambda c: (c is None, c)):
            continue
        for i, (role, text) in enumerate(turns):
            out.append((conv, i, f"<|im_start|>{role}\n{text}<|im_end|>\n", len(turns), len(same)))
    return sorted(out, key=str)


def formatted(spark, rows):
    return sorted(map(tuple, chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def test_snapshots_copies_and_odd_rows(spark):
    rows = [
        (1, 0, "user", "hi"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "hello"), (4, 2, "user", "bye"),
        (5, 0, "user", "hi"), (5, 1, "assistant", "other"),
        (6, 3, "user", "hi"), (6, 9, "assistant", "hello"),
        (7, 0, None, None), (7, 0, None, None), (7, None, "user", "late"),
        (8, 0, "user", "a"), (8, 0, "user", "b"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "y" * 100_000),
    ]
    assert formatted(spark, rows) == plain(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_logs(spark, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 5)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice("ab")))
    assert formatted(spark, rows) == plain(rows)


def test_one_conversation_holds_most_turns(spark):
    """It lies in several runs, and a log of its first half is found to be a snapshot."""
    rows = [(1, t, "user", f"t{t % 7}") for t in range(3000)] + [(2, t, "user", f"t{t % 7}") for t in range(1500)]
    rows += [(3, t, "user", f"t{t % 7}") for t in range(1400)] + [(3, 1400, "user", "turns away")]
    assert formatted(spark, rows) == plain(rows)


def test_positions_are_dense(spark):
    rows = [(1, 10 * t, "user", "x") for t in range(50)]
    rolled = chat.rolled(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["position"] for r in rolled.collect()) == list(range(50))


def test_empty_table_and_clashing_columns(spark):
    assert formatted(spark, []) == []
    more = spark.createDataFrame([(1, 0, "user", "x", "k", 1)], SCHEMA + ", key string, position int")
    assert [tuple(r) for r in chat.format_chats(more).collect()] == plain([(1, 0, "user", "x")])
