"""Base spans against the plain patterns, generators and selection by hand, and the model on texts that it has not seen."""

import random
import re

import numpy as np
import pytest

from armature.llm import boosting, pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), list(PLAIN).index(kind), m.end()))
    return sorted(out)


PARTS = ["1", "23", "255", "256", "0007", "4041894974608795", "4041 8949-7460 8795", "+1 (988) 555-2485", "+", "a@b.c", "a.b%c@x-y.z.w", "@", ".", "-", " ", "  ", "(", ")", "é", "\n", "x", "_", "42.144.35.254", "1.2.3.4.5", "+12", "d@e", "a@b.c_d@e.f"]


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_the_plain_patterns(seed):
    draw = random.Random(seed)
    for _ in range(3000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(14)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+" * 100_000, "1 " * 100_000, "+1" + " " * 200_000):
        pii.candidates(text, pii.zones_of(text))
        pii.base_spans(text)


def test_generators_propose_overlapping_spans():
    text = "call +1 (269) 555-3296 4524132264652876 or 1.2.3.4"
    said = {(pii.KINDS[k], text[a:b]) for a, k, b in pii.candidates(text, pii.zones_of(text))}
    assert {("phone", "+1 (269) 555-3296"), ("card", "4524132264652876"), ("ip", "1.2.3.4")} <= said
    assert pii.base_spans(text) == [(text.index("1.2"), pii.IP, len(text))]


def test_selection_keeps_base_spans_and_the_most_probable():
    base = [(10, pii.CARD, 20), (15, pii.PHONE, 25)]
    accepted = [(0.9, (24, pii.IP, 30)), (0.8, (30, pii.IP, 40)), (0.95, (35, pii.PHONE, 50)), (0.7, (0, pii.EMAIL, 10)), (0.6, (5, pii.EMAIL, 9))]
    got = [(a, k, b) for a, k, b, *_ in pii.select(base, accepted)]
    assert got == sorted([*base, (35, pii.PHONE, 50), (0, pii.EMAIL, 10)])
    assert pii.redacted("mail a@b.c now", [(5, pii.EMAIL, 10, True, 1.0)]) == "mail [EMAIL] now"


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((4000, 5))
    y = ((x[:, 0] > 0.5) != (x[:, 3] > 0.5)).astype(int)
    trees = boosting.fit(x[:3000], y[:3000])
    assert ((trees.margin(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.97
    assert len(boosting.fit(x[:10], np.ones(10)).feature) == 0
    assert boosting.fit(x[:0], y[:0]).margin(x[:3]).shape == (3,)


def test_threshold_is_the_least_precise_enough():
    p, y = np.array([0.99, 0.9, 0.9, 0.8, 0.7, 0.3]), np.array([1, 1, 1, 0, 1, 1])
    assert pii.threshold(p, y, 1.0) == 0.9
    assert pii.threshold(p, y, 0.8) == 0.7
    assert pii.threshold(p, np.zeros(6, int), 0.8) > 1


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["lorem", "ipsum", "été", "und", "the", "of", "12", "2.0", "x9"]

    def card():
        head = "4" + "".join(str(draw.randrange(10)) for _ in range(14))
        return next(head + str(c) for c in range(10) if pii.luhn(head + str(c)))

    kinds = {"email": lambda: f"ab{draw.randrange(99)}@mail.example.com", "ip": lambda: ".".join(str(draw.randrange(11, 250)) for _ in range(4)), "card": card, "phone": lambda: f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"}
    out = []
    for i in range(n):
        text = draw.choices(words, k=30)
        for _ in range(draw.randrange(4)):
            text.insert(draw.randrange(len(text)), draw.choice(list(kinds.values()))())
        out.append((i, " ".join(text)))
    return out


def test_added_spans_and_clean_texts(spark):
    known = spark.createDataFrame(corpus(1, 2000), "doc_id long, text string")
    model = pii.train(known)
    assert model.trees is not None
    phone, card = "+1 (269) 555-3296", "4524132264652876"
    asked = [(1, f"und {phone} {card} lorem"), (2, None), (3, ""), (4, "lorem 12 ipsum 2.0 the 300 und 2024-03-15 10.30 of 4524132264652877 x"), (5, "write to jim at mail dot example dot com und"), (5, "lorem " * 30_000 + "ab1@mail.example.com")]
    docs = spark.createDataFrame(asked, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS redacted", "3 AS id_hash")
    got = {}
    for r in pii.detect(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [(s.kind, s.base) for s in got[1][0].spans] == [("phone", False), ("card", False)]
    assert got[1][0].redacted == "und [PHONE] [CARD] lorem"
    assert got[2][0].spans == got[3][0].spans == [] and got[2][0].redacted == ""
    assert got[4][0].spans == []
    assert sorted(len(r.spans) for r in got[5]) == [1, 1] and all(s.kind == "email" for r in got[5] for s in r.spans)
    assert got[1][0].id_hash == 3


def test_no_sample_gives_base_spans_only(spark):
    model = pii.train(spark.createDataFrame([(1, "no data"), (None, None)], "doc_id long, text string"))
    assert model.trees is None
    assert [[(a, k, b) for a, k, b, *_ in f] for f in pii.find(["a@b.c x", "y"], model)] == [[(0, 0, 5)], []]
    empty = pii.train(spark.createDataFrame([], "doc_id long, text string"))
    assert pii.detect(spark.createDataFrame([], "doc_id long, text string"), empty).count() == 0
