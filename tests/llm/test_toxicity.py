"""Segments against brute force, and what the model says of planted passages."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from armature.llm import toxicity


def brute_segments(scores):
    """Maximal segments by their definition, taken recursively: the best run, then what is left and right of it."""

    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                # of equal sums the shortest, then the first
                if total > 1e-12 and (top is None or total > top[0] + 1e-9 or (abs(total - top[0]) <= 1e-9 and j - i < top[2] - top[1])):
                    top = (total, i, j)
        return top

    def walk(a, b):
        top = best(a, b)
        return [] if top is None else [*walk(a, top[1]), (top[1], top[2], round(top[0], 6)), *walk(top[2] + 1, b)]

    return walk(0, len(scores))


@pytest.mark.parametrize("seed", range(60))
def test_segments_equal_brute_force(seed):
    rng = random.Random(seed)
    drift, n = 0.3, 40
    gains = {p: rng.choice([1.137, 0.713, 2.011, 0.251, 3.391]) + rng.random() * 0.01 for p in sorted(rng.sample(range(n), rng.randrange(1, 14)))}
    scores = [gains.get(i, -drift) for i in range(n)]
    found = toxicity.maximal_segments(np.array(list(gains)), np.array(list(gains.values())), drift)
    assert [(a, b, round(s, 6)) for a, b, s in found] == brute_segments(scores)


def test_decay_solves_its_equation():
    share, gain, drift = np.array([0.01, 0.002]), np.array([2.0, 5.0]), 0.3
    x = toxicity._decay(share, gain, drift)
    assert abs((share * np.exp(x * gain)).sum() + (1 - share.sum()) * np.exp(-x * drift) - 1) < 1e-6 and x > 0


def test_evidence_grows_with_segments_and_shrinks_with_length():
    e = lambda n, s: toxicity.evidence(n, s, 1.5, -8.0)
    assert e(100, []) == 0 and e(100, [8.0]) > e(10_000, [8.0]) > 0
    assert e(100, [8.0, 8.0]) > e(100, [8.0]) > e(100, [5.0])


def corpus(spark, n=700, seed=4):
    rng = random.Random(seed)
    plain, nasty = [f"word{i}" for i in range(300)], ["vile", "rotten", "ghastly", "beastly"]
    docs, labels = [], []
    for d in range(n):
        text = [rng.choice(plain) for _ in range(rng.randrange(5, 200))]
        toxic = int(rng.random() < 0.2)
        for _ in range(4 * toxic):
            text.insert(rng.randrange(len(text) + 1), rng.choice(nasty).upper() + "!")
        docs.append((d, " ".join(text)))
        labels.append((d, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_passages(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels.filter("doc_id % 3 <> 1"))
    rows = toxicity.detect(docs, model).join(labels, "doc_id").filter("doc_id % 3 = 1").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.97 * len(rows)
    for r in rows:
        for p in r.passages:
            found = r.text.encode()[p.start : p.stop].decode()
            assert found.split()[0].strip("!").lower() in ("vile", "rotten", "ghastly", "beastly") and p.expected < 0.05


def test_odd_rows_and_no_labels(spark):
    docs, labels = corpus(spark, 300)
    model = toxicity.train(docs, labels.union(labels.limit(50)).union(spark.createDataFrame([(None, 1), (7, None)], "doc_id long, toxic int")))
    odd = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, " vile rotten " * 30_000), (3, "…")], "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("extra", F.lit(1))
    found = toxicity.detect(odd, model)
    assert found.columns.count("score") == 1 and "extra" in found.columns
    low = toxicity.score_of(model, np.array([0]), [[]])[0]
    assert [(r.doc_id, r.predicted) for r in found.collect()] == [(1, 0), (1, 0), (None, 0), (2, 1), (3, 0)]
    assert found.filter("doc_id = 1").first().score == low
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        constant = toxicity.train(docs, none)
        assert not len(constant.hashes) and {r.predicted for r in toxicity.detect(docs.limit(5), constant).collect()} == {0}
    assert toxicity.detect(odd.limit(0), model).count() == 0


def test_tokens_are_found_in_any_script():
    words, data = toxicity.tokens(pa.array(["Été, été! x-ray", "", "日本 語"], pa.large_string()))
    assert [bytes(data[a:b]).decode() for a, b in zip(words.start, words.end)] == ["Été", "été", "x", "ray", "日本", "語"]
    assert np.diff(words.first).tolist() == [4, 0, 2]


def test_the_bar_is_settled_on_the_other_half(spark):
    """Mild words that are not toxic but come along by chance are left out; mild words that make a passage toxic stay."""
    rng = random.Random(5)
    plain = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        words = rng.choices(plain, k=60)
        toxic = i % 6 == 0
        if toxic:
            words[20:32] = rng.choices([f"mild{j}" for j in range(12)], k=12)
        elif i % 6 == 1:
            words[rng.randrange(60)] = f"mild{rng.randrange(12)}"
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.filter("doc_id < 400"))
    assert 0 < len(model.hashes) and model.weights.max() < 8
    found = {r.doc_id: r for r in toxicity.detect(docs, model, keep=["doc_id"]).collect()}
    assert all(found[i].predicted == t for i, _, t in rows if i >= 400)
    again = toxicity.train(docs, labels.filter("doc_id < 400"))
    assert (again.hashes == model.hashes).all() and again.slope == model.slope


def test_negative_terms_break_segments():
    place, gain = np.array([0, 1, 2, 5]), np.array([2.0, -3.0, 2.5, 1.0])
    assert toxicity.maximal_segments(place, gain, 0.25) == [(0, 0, 2.0), (2, 5, 3.0)]
    assert toxicity.maximal_segments(place, np.array([2.0, -1.0, 2.5, 1.0]), 0.25) == [(0, 5, 4.0)]
