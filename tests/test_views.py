"""Chat turns with system turns anywhere, as rows, as SQL and by a plain loop."""

import duckdb

from armature.plans import views as W

SAID = [
    (1, 0, "system", "be kind"), (1, 1, "system", "and short"), (1, 2, "user", "hi"), (1, 3, "assistant", "hello"),
    (2, 0, "system", "alone"), (2, 1, "system", "still alone"),
    (3, 0, "user", "a"), (3, 1, "system", "now french"), (3, 2, "assistant", "b"), (3, 3, "system", "the end"),
    (4, 0, None, "whose"), (4, 1, "user", None), (4, None, "user", "first"),
    (5, 7, "user", "tie b"), (5, 7, "user", "tie a"), (5, 2000, "assistant", ""), (5, 90000, "user", "far"),
    (None, 0, "user", "nowhere"),
]
WANT = {
    (1, 0, "human", "be kind\nand short\nhi"), (1, 1, "gpt", "hello"),
    (2, 0, "human", "alone\nstill alone"),
    (3, 0, "human", "a"), (3, 1, "gpt", "now french\nb"), (3, 2, "human", "the end"),
    (4, 0, "human", "first"), (4, 1, "gpt", "whose"), (4, 2, "human", ""),
    (5, 0, "human", "tie a"), (5, 1, "human", "tie b"), (5, 2, "gpt", ""), (5, 3, "human", "far"),
}


def test_system_turns_open_what_follows(spark, tmp_path):
    said = spark.createDataFrame(SAID, "conv_id long, turn int, role string, text string")
    said.write.parquet(str(tmp_path / "conversations.parquet"))
    got = [tuple(r) for r in W.turns(spark, str(tmp_path)).select("conv_id", "turn_idx", "role", "text").collect()]
    assert len(got) == len(WANT) and set(got) == WANT
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert set(duck.execute(W.sql("v_turns", "SELECT conv_id, turn_idx, role, text FROM v_turns")).fetchall()) == WANT


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert W.turns_of(empty).collect() == []
