"""Totals after any history equal totals counted anew."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from armature.llm import rollups
from armature.sources.sinks import scratch

SCHEMA = "doc_id long, source string, lang string, tokenizer string, tokens long, chars long"


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in store.totals().collect()}


def plain(state):
    out = Counter(), Counter(), Counter()
    for (_, version), (source, lang, tokens, chars) in state.items():
        for c, v in zip(out, (1, tokens, chars)):
            c[source, lang, version] += v
    return {k: (out[0][k], out[1][k], out[2][k]) for k in out[0]}


def test_histories_with_replays(spark):
    rng = random.Random(3)
    store, state = rollups.Store(spark, scratch(spark, "test-rollups")), {}
    for batch in range(7):
        if batch % 3 == 2:
            ids = [rng.randrange(40) for _ in range(12)]
            for _ in range(2):
                store.delete(f"b{batch}", spark.createDataFrame([(i,) for i in [*ids, 999]], "doc_id long"))
            state = {k: v for k, v in state.items() if k[0] not in ids}
        else:
            rows = {(rng.randrange(40), v): (rng.choice(["s", None]), rng.choice(["en", "de", None]), rng.randrange(90), rng.randrange(900)) for v in ("v1", "v2") for _ in range(25)}
            df = spark.createDataFrame([(d, s, la, v, t, c) for (d, v), (s, la, t, c) in rows.items()], SCHEMA)
            assert store.put(f"b{batch}", df) and not store.put(f"b{batch}", df.limit(1))
            state |= rows
        assert totals(store) == plain(state)


def test_attempts_without_a_commit_do_not_count(spark):
    store = rollups.Store(spark, scratch(spark, "test-rollups"))
    row = spark.createDataFrame([(1, "s", "en", "v1", 5, 9)], SCHEMA)
    store.put("one", row)
    for name in ("changes", "deltas"):
        attempt = store.commits().first()["attempt"]
        spark.read.parquet(f"{store.folder}/{name}/attempt={attempt}").write.parquet(f"{store.folder}/{name}/attempt=died")
    assert totals(store) == {("s", "en", "v1"): (1, 5, 9)}
    store.put("two", row)  # the retry
    assert totals(store) == {("s", "en", "v1"): (1, 5, 9)}
    assert not store._commit(2, {"batch": "two", "attempt": "died"})  # a second writer of a version
    assert totals(store) == {("s", "en", "v1"): (1, 5, 9)} and store.commits().count() == 2


def test_of_two_batches_at_once_the_second_starts_again(spark):
    """Both take document 1 out: the one that commits second must see that it is gone."""
    folder = scratch(spark, "test-rollups")
    store, other = rollups.Store(spark, folder), rollups.Store(spark, folder, buckets=3)
    assert other.buckets == rollups.BUCKETS
    store.put("one", spark.createDataFrame([(1, "s", "en", "v1", 5, 9), (2, "s", "en", "v1", 7, 9)], SCHEMA))
    worked_out, raced = store._worked_out, []

    def slow(*arguments):
        attempt = worked_out(*arguments)
        if not raced:
            raced.append(other.delete("theirs", spark.createDataFrame([(1,)], "doc_id long")))
        return attempt

    store._worked_out = slow
    assert store.apply("ours", spark.createDataFrame([(3, "t", "en", "v1", 4, 4)], SCHEMA), spark.createDataFrame([(1,)], "doc_id int"))
    assert raced == [True] and totals(store) == {("s", "en", "v1"): (1, 7, 9), ("t", "en", "v1"): (1, 4, 4)}
    assert [r["batch"] for r in store.commits().orderBy("version").collect()] == ["one", "theirs", "ours"]


def test_compacted_stores_go_on(spark):
    store = rollups.Store(spark, scratch(spark, "test-rollups"), buckets=8)
    rows = lambda ids, tokens: spark.createDataFrame([(i, "s", "en", "v1", tokens, 1) for i in ids], SCHEMA)
    store.put("one", rows([*range(40), None, None], 1))
    store.put("two", rows(range(20), 5))
    store.delete("three", spark.createDataFrame([(i,) for i in range(30, 40)], "doc_id long"))
    before = totals(store)
    assert before == {("s", "en", "v1"): (32, 100 + 10 + 2, 32)}
    store.compact()
    assert totals(store) == before and len(store._newest()[1]) == 1 and not store.put("two", rows(range(20), 9))
    store.delete("four", spark.createDataFrame([(0,), (35,)], "doc_id long"))
    assert totals(store) == {("s", "en", "v1"): (31, 107, 31)}
    assert {(r["doc_id"], r["copies"]) for r in store.current().collect()} == {(i, 1) for i in range(1, 30)} | {(None, 2)}


def test_an_update_reads_only_its_buckets(spark):
    store = rollups.Store(spark, scratch(spark, "test-rollups"), buckets=16)
    store.put("one", spark.createDataFrame([(i, "s", "en", "v1", 1, 1) for i in range(400)], SCHEMA))
    (bucket,) = spark.createDataFrame([(7,)], "doc_id int").select(store.bucket(F.col("doc_id"))).first()
    read = store._current(store._newest()[1], [bucket])
    assert 0 < read.count() < 60 and read.filter("doc_id = 7").count() == 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_odd_rows(spark):
    store = rollups.Store(spark, scratch(spark, "test-rollups"))
    rows = [(1, "s", "en", "v1", 5, 9), (1, "s", "en", "v1", 5, 9), (1, "t", "en", "v1", 4, 9), (None, "s", None, "v1", 2, 3), (None, "s", None, "v1", 2, 3)]
    store.put("one", spark.createDataFrame(rows, SCHEMA))
    assert totals(store) == {("s", "en", "v1"): (1, 5, 9), ("s", None, "v1"): (2, 4, 6)}
    store.put("none", spark.createDataFrame([], SCHEMA))
    store.delete("nobody", spark.createDataFrame([(None,), (77,)], "doc_id long"))
    assert totals(store)[("s", "en", "v1")] == (1, 5, 9) and store.commits().count() == 3


def test_counters(spark):
    texts = [None, "", "Don't stop, 42 times!  日本", "x" * 50_000]
    docs = spark.createDataFrame([(i, t, "s", "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string, tokens int")
    found = {(r.doc_id, r.tokenizer): (r.tokens, r.chars) for r in rollups.counted(docs, {"w": rollups.words, "p": rollups.pieces}).collect()}
    assert [found[i, "w"][0] for i in range(4)] == [0, 0, 5, 1] and [found[i, "p"][0] for i in range(4)] == [0, 0, 9, 1]
    assert [found[i, "w"][1] for i in range(4)] == [len(t or "") for t in texts]


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.json"), reason="no vocabulary here")
def test_byte_pairs_count_what_the_library_counts(spark):
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/byte_bpe_50k.json"
    texts = ["Hello world, hello <|endoftext|>", "", None, "naïve café 12345"]
    docs = spark.createDataFrame([(i, t, "s", "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    found = {r.doc_id: r.tokens for r in rollups.counted(docs, {"bpe": rollups.byte_pairs(path)}).collect()}
    assert found == {i: len(made.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
