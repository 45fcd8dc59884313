"""SimHash groups against brute force, and the reach of the Golay keys."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from armature.llm import simhash

GOLAY = simhash.Golay()


def words_at_distance(rng, words, bits):
    out = words.copy()
    for row in range(len(words)):
        for bit in rng.choice(23, bits, replace=False):
            out[row] ^= np.uint32(1 << int(bit))
    return out


def nearby_sets(words):
    rows, codes = GOLAY.nearby(words)
    out = [set() for _ in words]
    for r, c in zip(rows.tolist(), codes.tolist()):
        out[r].add(c)
    return out


def test_every_word_is_near_one_codeword():
    words = np.arange(1 << 23, dtype=np.uint32)[:: 97]
    error = GOLAY.leaders[GOLAY.syndrome(words)]
    assert np.bitwise_count(error).max() <= 3
    assert not GOLAY.syndrome(words ^ error).any()
    assert set(GOLAY.count) == {1, 6}


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_words_at_two_bits_share_a_nearby_codeword(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(0, 1 << 23, 4000).astype(np.uint32)
    b = words_at_distance(rng, a, bits)
    assert all(x & y for x, y in zip(nearby_sets(a), nearby_sets(b)))
    if bits <= 1:
        assert all(c in x for x, c in zip(nearby_sets(a), GOLAY.nearest(b).tolist()))


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_linked_fingerprints_share_a_key(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    b = a.copy()
    for row in range(len(a)):
        for bit in rng.choice(64, bits, replace=False):
            b[row] ^= np.uint64(1) << np.uint64(bit)

    def key_sets(f):
        out = [set() for _ in f]
        rows, keys = simhash.keys_of(f.view(np.int64), GOLAY)
        for r, k in zip(rows.tolist(), keys.tolist()):
            assert k not in out[r]
            out[r].add(k)
        return out

    assert all(x & y for x, y in zip(key_sets(a), key_sets(b)))


def roots(values, bits):
    """Brute force: value -> least value of its component, as unsigned numbers."""
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = list(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def grouped(pairs):
    out = {}
    for member, root in pairs:
        out.setdefault(root, set()).add(member)
    return sorted(map(sorted, out.values()))


def sample_values(seed, groups, size):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(groups):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(size):
            for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                at ^= 1 << int(bit)
            out.add(at)
    return out


@pytest.mark.parametrize("chunk", [32768, 5])
def test_links_and_components(spark, chunk):
    values = sample_values(1, 12, 14) | {0, 1, (1 << 64) - 1, (1 << 64) - 3}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "f long"), chunk=chunk)
    assert all((r.a ^ r.b).bit_count() <= 4 or bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4 for r in edges.collect())
    found = {r.node % (1 << 64): r.root for r in simhash.components(edges).collect()}
    want = [g for g in grouped(roots(values, 4).items()) if len(g) > 1]
    assert grouped(found.items()) == want


def test_a_tight_group_gives_a_forest(spark):
    base = 0x1234_5678_9ABC_DEF0
    near = [(base ^ (1 << a) ^ (1 << b),) for a in range(40) for b in range(a)]
    edges = simhash.links(spark.createDataFrame(near, "f long"))
    # at most a tree per key, never all 304 000 pairs
    assert edges.count() < 30 * len(near)
    assert simhash.components(edges).select("root").distinct().count() == 1


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7000, 7000)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]).encode() for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [
    "one two three four five six seven eight nine ten",
    "One TWO three four five\tsix seven eight nine ten ",
    "one two", "", None, " \n\t\v\f\r ", "Été à la plage été à la plage", "été À la plage", "x" * 5000, "word joined by no-break space",
    "a b c d a b c d a b c d a b c d", " ".join(f"w{i % 911}" for i in range(70_000)),
]


def test_fingerprints_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: f"{fingerprint(t):016x}" for i, t in enumerate(TEXTS)}


def test_rows_that_are_odd(spark):
    rows = [(5, "same text here now", "a"), (5, "same text here now", "b"), (3, "same text here now", "c"), (None, "same text here now", "d"), (None, "alone in the world today", "e"), (None, "alone in the world today", "e"), (9, None, "f"), (8, "", "g"), (7, " ", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f string").withColumn("fingerprint", F.lit(1)).withColumn("kept_id", F.lit("x"))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in found) == sorted([(5, 3), (5, 3), (3, 3), (-1, 3), (-1, -1), (-1, -1), (9, 7), (8, 7), (7, 7)])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.f) for r in kept.collect()) == [(-1, "e"), (3, "c"), (7, "h")]
    twice = simhash.keep_one(docs.filter("doc_id = 5"))
    assert [(r.doc_id, r.f) for r in twice.collect()] == [(5, "a")]
    none = docs.limit(0)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_reach_is_checked(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "f long"), bits=5)
