"""Spaced seeds against a comparison of all windows."""

import random
import re

from pyspark.sql import functions as F

from armature.llm import decontaminate


def words(text):
    return re.findall(r"[a-z0-9]+", (text or "").lower())


def brute(docs, items, span=13, least=5):
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            n = min(span, len(v))
            if n < least:
                # word for word as a whole line
                at = 0
                for line in (text or "").split("\n"):
                    if v and words(line) == v:
                        out.setdefault((d, i), []).append((at, n))
                    at += len(words(line))
                continue
            need = n - int(n * 0.2 + 1e-9)
            for a in range(len(w) - n + 1):
                for b in range(len(v) - n + 1):
                    equal = sum(x == y for x, y in zip(w[a : a + n], v[b : b + n]))
                    if equal >= need:
                        out.setdefault((d, i), []).append((a, equal))
    return {k: (len({a for a, _ in v}), max(e for _, e in v), min(a for a, _ in v)) for k, v in out.items()}


def made(seed=3):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([3, 5, 8, 12, 13, 20, 40])))) for i in range(25)]
    docs = []
    for d in range(120):
        body = [rng.choice(pool) for _ in range(rng.randrange(0, 60))]
        if d % 2:
            passage = words(rng.choice(items)[1])
            for _ in range(rng.randrange(0, 6)):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append((d, " ".join(body)))
    short = [t for _, t in items if len(words(t)) < 5]
    docs += [(1000, short[0].upper() + "!"), (1001, f"w1 w2\n{short[0]}\nw3"), (1002, f"w1 {short[0]}"), (1003, f"\n\n{short[0]}\n{short[0]}")]
    return docs, items


def test_finds_what_brute_force_finds(spark):
    docs, items = made()
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    found = {(r.doc_id, r.item_id): (r.n_windows, r.equal_words, r.first_word) for r in got.collect()}
    want = brute(docs, items)
    assert found == want and len(want) > 20


def test_any_two_substitutions_leave_a_seed():
    import numpy as np

    rng = np.random.default_rng(1)
    for span in range(5, 14):
        base = rng.integers(1, 1 << 62, span).astype(np.uint64)
        mine = [int(s[0]) for s in decontaminate.seeds(base, span)]
        for i in range(span):
            for j in range(i + 1):
                other = base.copy()
                other[[i, j]] += np.uint64(7)
                assert any(int(s[0]) == m for s, m in zip(decontaminate.seeds(other, span), mine))


def test_odd_rows(spark):
    item = "The quick, brown fox — jumps over the lazy dog while seven wizards sing"
    rows = [(1, item, 1), (1, item, 1), (2, None, 2), (3, "", 3), (None, "x " * 30 + item.upper(), 4), (4, "clean words only here", 5), (5, " ".join(f"n{i}" for i in range(60_000)) + " " + item, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word long").withColumn("text_key", F.lit("kept"))
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "too few words")], "item_id long, text string").withColumn("seed", F.lit(1))
    found = decontaminate.overlaps(docs, bench, ["doc_id"]).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in found) == [(-1, 1), (-1, 2), (1, 1), (1, 2), (5, 1), (5, 2)]
    clean = decontaminate.without_benchmark(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4]
    assert decontaminate.without_benchmark(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.overlaps(docs.limit(0), bench, ["doc_id"]).count() == 0


def test_short_items_and_clashing_names(spark):
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "..."), (3, None), (4, "solo")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha, beta", 7), (2, "so alpha beta", 7), (3, "x\nSOLO.\ny", 7), (4, "x " * 50_000 + "\nalpha beta", 7)], "word long, text string, seed int")
    got = decontaminate.overlaps(docs, items, ["word", "seed"])
    assert {(r.word, r.item_id, r.equal_words, r.span, r.first_word) for r in got.collect()} == {(1, 1, 2, 2, 0), (3, 4, 1, 1, 1), (4, 1, 2, 2, 50_000)}
