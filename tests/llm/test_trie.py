"""The prefix trie against plain dictionaries, over many small blocks."""

import hashlib
import random

import numpy as np
import pytest

from armature.llm import trie


def plain(turns):
    """Every column of every node, from {conv_id: [(role, text)]}."""
    members = {}
    for conv, said in turns.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(conv)
    name = {p: min(m) for p, m in members.items()}
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(turns[c]) == len(p))
        out.add((name[p], len(p), name[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, turns):
    rows = [(c, i, *t) for c, said in turns.items() for i, t in enumerate(said)]
    seqs = trie.sequences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    empty = [c for c, said in turns.items() if not said]
    if empty:
        seqs = seqs.unionByName(spark.createDataFrame([(c, []) for c in empty], seqs.schema))
    nodes, ends = trie.prefix_trie(seqs)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nothing = hashlib.sha256(b"").hexdigest()
    digests = {(r.conv_id, r.depth): r.ends_sha256 for r in trie.ends_digest(ends).collect()}
    rows = [tuple(r[n] for n in names) for r in nodes.collect()]
    assert len(set(rows)) == len(rows)
    return {(*r, digests.get(r[:2], nothing)) for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nodes_equal_a_plain_trie_over_small_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(trie, "MOST_TURNS", 40)
    monkeypatch.setattr(trie, "PIECE", 3)
    draw = random.Random(seed)
    kinds = [(r, t) for r in ("user", "assistant") for t in ("", "a", "bé", "ccc")][: 3 + seed]
    turns = {c: [draw.choice(kinds) for _ in range(draw.randrange(7))] for c in range(90)}
    # a third are copies of one conversation, which spans several blocks
    turns |= {1000 + c: [kinds[0], kinds[1], kinds[0]] for c in range(60)}
    assert found(spark, turns) == plain(turns)


def test_small_tables(spark):
    one = {7: [("user", "x"), ("assistant", "y")]}
    assert found(spark, one) == plain(one)
    bare = {3: [], 4: []}
    assert found(spark, bare) == plain(bare)
    assert found(spark, {}) == set()
    long_ = {1: [("user", str(i)) for i in range(120)], 2: [("user", str(i)) for i in range(119)] + [("user", "z" * 100_000)]}
    assert found(spark, long_) == plain(long_)


def test_sequences_of_nulls_ties_and_repeated_rows(spark):
    rows = [(1, 1, "b", "x"), (1, None, None, None), (1, 1, "a", "y"), (1, 1, "a", "y"), (None, 0, "user", "lost"), (2, 5, "", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS id", "'?' AS turns", "0 AS key")
    got = {r.id: r.turns for r in trie.sequences(df).collect()}
    assert sorted(got) == [1, 2]
    assert [t.bytes for t in got[1]] == [0, 1, 1, 1]
    assert got[1][0].key == got[2][0].key and got[1][1].key == got[1][2].key != got[1][3].key


def test_extents_equal_a_walk():
    draw = np.random.default_rng(5)
    lcp = draw.integers(0, 5, 200)
    lcp[0] = -1
    table = trie.Minima(lcp)
    place, depth = draw.integers(0, 200, 500), draw.integers(0, 6, 500)
    left, right = table.left(place, depth), table.right(place, depth)
    for p, d, a, b in zip(place, depth, left, right, strict=True):
        x = y = p
        while x > 0 and lcp[x] >= d:
            x -= 1
        while y + 1 < 200 and lcp[y + 1] >= d:
            y += 1
        assert (a, b) == (x, y)
