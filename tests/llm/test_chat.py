"""Chats out and back."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from armature.llm import chat

BITS = [*chat.CONTROLS, chat.MARKER, "<", "|", "[", "<" + chat.MARKER + "|end|>", "hello ", "é", "\n", "\\", "$1", "😀", ""]


def shown(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("id", F.lit(2))
    found = chat.format_chats(df, **options)
    return {r.conv_id: r for r in found.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_round_trip_of_control_strings(spark):
    rng = random.Random(5)
    said = lambda: "".join(rng.choice(BITS) for _ in range(rng.randrange(7)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|says|>", ""]), said()) for c in range(60) for t in range(rng.randrange(1, 9))]
    found = shown(spark, rows)
    for c, r in found.items():
        want = [(x[2], x[3]) for x in rows if x[0] == c]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")
        assert r.n_messages == 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert not any(f in r.formatted for f in chat.FOREIGN)
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == r.n_messages


def test_digest_is_of_utf8(spark):
    got = spark.range(1).select(chat.digest(F.lit("é\n")).alias("d")).first().d
    assert got == hashlib.sha256("é\n".encode()).hexdigest()


def test_order_nulls_ties_and_repeats(spark):
    rows = [(1, 2, "user", "b"), (1, 2, "assistant", "a"), (1, None, "system", None), (1, 3, None, "x"), (1, 3, None, "x"), (None, 0, "user", "no id"), (2, 0, "assistant", "long " * 200_000)]
    found = shown(spark, rows)
    assert [(t.role, t.text) for t in found[1].turns] == [("system", ""), ("assistant", "a"), ("user", "b"), ("", "x"), ("", "x")]
    assert [(t.role, t.text) for t in found[None].turns] == [("user", "no id")] and found[None].loss == ""
    assert found[2].loss == "long " * 200_000
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_a_bound_is_an_error(spark):
    with pytest.raises(Exception, match="more than 2 turns"):
        shown(spark, [(1, i, "user", "x") for i in range(3)], most_turns=2)


def test_equal_turn_numbers_go_by_role_then_text_as_written(spark):
    rows = [(1, 0, "user", "<sa"), (1, 0, "user", "<s>"), (1, 0, "user", "[INST]"), (1, 0, "user", "[INSA"), (1, 0, "assistant", "z")]
    found = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = found.select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in read] == sorted((r[2], r[3]) for r in rows)
