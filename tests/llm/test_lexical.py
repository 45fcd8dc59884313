"""Ranked search against a plain scoring of every document."""

import math
import random
import re

import numpy as np
import pytest

from armature.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    held = [(i, terms_of(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in held if t), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    for item, wanted in asked.items():
        scores = []
        for doc, t in held:
            s = 0
            for x in wanted & set(t):
                m = 100 - 90 + (90 * len(t) * n_docs) // n_terms
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * t.count(x)) // (1000 * t.count(x) + 8 * m))
            if s > 0:
                scores.append((-s, doc is None, doc if doc is not None else 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, tmp_path, docs, items, k=3):
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "'x' AS term", "2 AS segment", "3 AS places", "4 AS impacts")
    index = lexical.build_index(table.repartition(3), str(tmp_path / "index"))
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS rank")
    return sorted((tuple(r) for r in lexical.search(spark, index, asked, k).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_ranking_over_small_segments_and_blocks(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(lexical, "PAIRS_AT_ONCE", 20)
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x-y", "A.B"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(draw.choices(words, weight, k=draw.randrange(40)))) for i in range(250)]
    docs += [(i + 1000, "w1 w2 w3 Été") for i in range(60)]  # copies: ties go by id
    docs += [(5000, None), (None, "w1 w1 w2"), (None, "w40 w41"), (5001, ""), (5002, "w0 " * 30_000), (1000, "w1 w2 w3 Été")]
    items = [(i, " ".join(draw.choices(words, k=12))) for i in range(8)] + [(20, "W1 w2, w3 été!"), (20, "w4"), (21, None), (22, "absent"), (None, "w40")]
    assert found(spark, tmp_path, docs, items) == plain(docs, items, 3)


def test_empty_tables(spark, tmp_path):
    assert found(spark, tmp_path / "a", [], [(1, "x")]) == []
    assert found(spark, tmp_path / "b", [(1, "x"), (2, None)], []) == []
    assert found(spark, tmp_path / "c", [(1, None), (2, "...")], [(1, "x")]) == []


def test_rounds_stop_only_when_scores_are_final():
    draw = np.random.default_rng(3)
    for _ in range(200):
        documents, k = int(draw.integers(1, 400)), int(draw.integers(1, 6))
        lists, total = [], np.zeros(documents, np.int64)
        for _ in range(int(draw.integers(1, 7))):
            place = draw.permutation(documents)[: int(draw.integers(1, documents + 1))]
            score = -np.sort(-draw.integers(0, 30, len(place)))
            by = np.lexsort((place, -score))
            lists.append((place[by], score[by]))
            total[place[by]] += score[by]
        floor = int(draw.integers(0, 60))
        best, score = lexical.no_random_access(lists, documents, k, floor)
        want = [p for p in np.lexsort((np.arange(documents), -total)) if total[p] >= max(1, floor)][:k]
        assert list(best) == want and list(score) == list(total[want])


def test_impacts_beyond_64_bits():
    small = lexical.impacts(np.array([2]), np.array([10]), 1000, 50_000)
    assert small[0] == (2 * 10**9) // (2000 + 8 * (10 + 90 * 10 * 1000 // 50_000))
    large = lexical.impacts(np.array([2]), np.array([10**9]), 10**12, 10**15)
    assert large[0] == (2 * 10**9) // (2000 + 8 * (10 + 90 * 10**9 * 10**12 // 10**15))
