"""Targets, tilts and copies of the mix."""

import random
import re

import pytest
from pyspark.sql import functions as F

from armature.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        room = left - sum(capped.values())
        part = {s: room * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if part[s] > most * sizes[s]]
        if not above:
            return {**capped, **part}
        for s in above:
            capped[s] = most * sizes[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing_by_hand(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 3, 50, 1000, 90_000]) + rng.randrange(5) for s in [*(f"s{i}" for i in range(rng.randrange(2, 14))), "Ω", "😀", None]}
    found = mixing.rotating_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got, want = {r.source: r.target for r in found.collect()}, plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in got)


def corpus(spark, n=900, seed=1):
    rng = random.Random(seed)
    rows = [(d, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 200]))), rng.choice(["big", "big", "big", "b", "c", None])) for d in range(n)]
    return spark.createDataFrame([*rows, (None, "a b c", "c"), (5, None, "c"), (5, None, "c")], "doc_id long, text string, source string")


def test_mix_meets_its_targets(spark):
    docs = corpus(spark)
    rows = mixing.mix(docs.withColumn("size", F.lit("clash")).withColumn("key", F.lit(1))).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    sums = {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size and abs(r.copies - r.rate) <= 2
        sums.setdefault(r.source, [0, 0, r.source_size, r.target])
        sums[r.source][0] += r.taken
        sums[r.source][1] += r.size
    want = plain_targets({s: v[1] for s, v in sums.items()})
    for s, (taken, size, source_size, target) in sums.items():
        assert size == source_size and abs(target - want[s]) < 1e-6 * target
        assert abs(taken - target) <= max(5, 0.001 * target)


def test_reruns_and_partitions_agree(spark):
    docs = corpus(spark)
    one = sorted(mixing.mix(docs).collect(), key=repr)
    assert one == sorted(mixing.mix(docs.repartition(7)).collect(), key=repr)


def test_tilts_with_base_rates_solve_the_dual(spark):
    cells = spark.createDataFrame([("a", 0.5, 1000), ("a", 1.9, 500), ("b", 1.0, 10), ("c", 1.0, 0), ("d", 0.1, 100)], "key string, base double, tokens long")
    goal = {"a": 2500.0, "b": 20.0, "c": 0.0, "d": 3.0}
    targets = spark.createDataFrame(list(goal.items()), "key string, target double")
    tilt = {r.key: r.tilt for r in mixing.tilts(cells, targets).collect()}
    from math import exp

    for key, want in goal.items():
        got = sum(r.tokens * min(2.0, r.base * exp(tilt[key])) for r in cells.collect() if r.key == key)
        assert abs(got - want) <= 1e-6 * max(1, want)


def test_empty_and_wordless_tables(spark):
    docs = corpus(spark)
    assert mixing.mix(docs.limit(0)).count() == 0
    rows = mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect()
    assert {(r.size, r.taken, r.target) for r in rows} == {(0, 0, 0.0)}
