"""Cross-parsing against a plain parser, and the additive model on shapes it must learn."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from armature.llm import gam, langid, quality


def plain_phrases(text, known):
    """Longest matches, one after the other; a symbol that is nowhere is a phrase of its own. Lanes begin anew."""
    count = 0
    for at in range(0, len(text), langid.LANE):
        lane, i = text[at : at + langid.LANE], 0
        while i < len(lane):
            j = i + 1
            while j <= len(lane) and lane[i:j] in known:
                j += 1
            i = max(i + 1, j - 1)
            count += 1
    return count


def test_phrases_equal_a_plain_parser():
    rng = random.Random(1)
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [say("abc ", 300), say("bcd", 200)]
    bounds = langid.Bounds()
    model = langid.build(["x", "y"], [pa.array([t], pa.large_string()) for t in texts], bounds)
    reduced = lambda t: "".join(map(chr, langid.to_symbols(pa.array([t], pa.large_string()), model.symbols)[0]))
    known = [reduced(t) for t in texts]
    tried = [say("abcd e.", rng.randrange(0, 900)) for _ in range(80)] + ["", "zzz", "a"]
    symbols, starts = langid.to_symbols(pa.array(tried, pa.large_string()), model.symbols)
    found = langid.phrases(model, symbols, starts)
    for row, k in enumerate(known):
        assert found[row].tolist() == [plain_phrases(reduced(t), k) for t in tried]


SAYINGS = {"en": "the of and that this with from have been what when where", "de": "der die das und nicht mit auf ein eine sich auch werden", "xx": "ква мур гав хрю бее ляля тру"}


def speech(spark, n=240, seed=2):
    rng = random.Random(seed)
    rows = [(d, " ".join(rng.choice(SAYINGS[lang].split()) for _ in range(rng.randrange(3, 60))), lang) for d in range(n) for lang in [rng.choice(sorted(SAYINGS))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_texts(spark):
    docs = speech(spark)
    model = langid.train(docs.filter("doc_id % 3 <> 1"), "text", "lang", "doc_id")
    rows = langid.identify(docs, model).filter("doc_id % 3 = 1").collect()
    assert all(r.lang_pred == r.lang and 0.5 < r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    docs = speech(spark)
    model = langid.train(docs.union(docs).union(spark.createDataFrame([(1, None, "en"), (None, "the of and", "en"), (2, "x", None)], docs.schema)), "text", "lang", "doc_id")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 -- !"), (None, "und nicht die und auf ein " * 20_000), (3, "ጤና ይስጥልኝ ሰላም")], "doc_id long, text string").withColumn("score", F.lit("mine"))
    found = langid.identify(odd, model).collect()
    assert [r.lang_pred for r in found[:4]] == ["und", "und", "und", "de"] and [r.score for r in found[:3]] == [0, 0, 0]
    assert found[4].lang_pred in SAYINGS and found[4].score < 0.4  # no language knows it
    nothing = langid.train(docs.limit(0), "text", "lang", "doc_id")
    assert {(r.lang_pred, r.score) for r in langid.identify(docs.limit(5), nothing).collect()} == {("und", 0.0)}
    assert langid.identify(odd.limit(0), model).count() == 0


def test_letters_beyond_the_columns_are_symbols():
    rng = random.Random(4)
    han, hangul = [chr(0x4E00 + k) for k in range(700)], [chr(0xAC00 + k) for k in range(500)]
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [say([*han[:400], " ", "a"], 3000), say([*hangul, " "], 2000), say("abcdefgh ", 6000), say(han[300:], 900)]
    model = langid.build(list("wxyz"), [pa.array([t], pa.large_string()) for t in texts], langid.Bounds())
    reduced = lambda t: "".join(map(chr, langid.to_symbols(pa.array([t], pa.large_string()), model.symbols)[0]))
    assert len(set(reduced("".join(sorted(set("".join(texts)) - {" "}))))) == len(set("".join(texts)) - {" "})
    tried = [t[a : a + rng.randrange(400)] for t in texts for a in range(0, 600, 50)] + [say([*han, *hangul, "a", " "], 700), "", "zz"]
    symbols, starts = langid.to_symbols(pa.array(tried, pa.large_string()), model.symbols)
    found, lacking = langid.phrases(model, symbols, starts), langid.misses(model, symbols, starts)
    for row, t in enumerate(texts):
        known = reduced(t)
        assert found[row].tolist() == [plain_phrases(reduced(x), known) for x in tried]
        assert lacking[row].tolist() == [sum(c not in known for c in reduced(x)) for x in tried]


def test_no_language_wins_by_lack_of_letters_or_text(spark):
    rng = random.Random(5)
    scripts = {"han": range(0x4E00, 0x4E00 + 600), "hangul": range(0xAC00, 0xAC00 + 600), "ethiopic": range(0x1208, 0x1208 + 30)}
    words = {k: ["".join(chr(rng.choice(v)) for _ in range(3)) for _ in range(200)] for k, v in scripts.items()} | {k: v.split() for k, v in SAYINGS.items()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(1 if k == "ethiopic" else 40)), k) for i, k in enumerate(sorted(words) * 30)]
    few = [(1000, "", "a_none"), (1001, "--", "a_none"), (1002, "th", "a_two"), (1003, "e", "a_one")]
    docs = spark.createDataFrame(rows + few, "doc_id long, text string, lang string")
    model = langid.train(docs, "text", "lang", "doc_id")
    found = langid.identify(docs.filter("doc_id < 1000"), model).collect()
    assert [r for r in found if r.lang_pred != r.lang or not r.score > 0.5] == []


def test_every_sampled_text_has_its_share():
    t = ["a" * 30_000, "bc" * 30, "d" * 9000, ""]
    symbols, _ = langid.letter_symbols([pa.array(t, pa.large_string())])
    got = langid.sampled(*langid.to_symbols(pa.array(t, pa.large_string()), symbols), 10_003)
    seen = np.bincount(got)
    assert len(got) <= 10_003 and seen[1] == 4970 and seen[2] == seen[3] == 30 and seen[4] == 4970
    assert len(langid.sampled(*langid.to_symbols(pa.array([t[0]], pa.large_string()), symbols), 500)) == 500


def test_long_texts_copies_and_repeated_ids_leave_room_for_the_others(spark):
    rng = random.Random(6)
    say = lambda k, n: " ".join(rng.choice(SAYINGS[k].split()) for _ in range(n))
    texts = [("en", "aa " * 6600, i) for i in range(40)]  # copies, first in order, that fill the model
    texts += [("en", say("en", 30), 100 + i) for i in range(40)]
    texts += [("de", say("de", 6000), 200 + i) for i in range(20)]  # only texts of more than 20000 characters
    texts += [("xx", say("xx", 30), 300 + i % 3) for i in range(900)]  # few ids
    docs = spark.createDataFrame([(i, t, k) for k, t, i in texts], "doc_id long, text string, lang string")
    model = langid.train(docs, "text", "lang", "doc_id")
    assert model.languages == ["de", "en", "xx"] and model.bits.min() > 12
    tried = spark.createDataFrame([(i, say(k, 8), k) for i, k in enumerate(sorted(SAYINGS) * 20)], docs.schema)
    assert [r for r in langid.identify(tried, model).collect() if r.lang_pred != r.lang or r.score < 0.9] == []


def test_additive_model_learns_shapes_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    bump = np.abs(x[:, 0] - 0.5) < 0.2
    cross = (x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)
    y = (bump | cross).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert (2, 1) in model.pairs
    assert len(gam.fit(x[:0], y[:0]).tables) == 4
    assert abs(gam.fit(x, np.ones(4000)).score(x[:3]) - 1).max() < 0.01


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3)).round(2)
    y = (x[:, 0] + x[:, 1] > 1).astype(float)
    model = gam.fit(x, y)
    for row in x[:20]:
        bins = [sum(row[i] >= e for e in model.edges[i]) for i in range(3)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[bins[i], bins[j]] for (i, j), t in zip(model.pairs, model.pair_tables))
        assert abs(model.margin(row[None])[0] - total) < 1e-9


def plain_features(text):
    lines = [x for x in text.split("\n") if x]
    words = text.lower().split()
    return {
        "words": len(words),
        "distinct": len(set(words)) / max(1, len(words)),
        "common": max((words.count(w) for w in set(words)), default=0) / max(1, len(words)),
        "repeated_lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
        "ended": sum(x[-1] in ".!?\"'" for x in lines) / max(1, len(lines)),
        "triples": (max(0, len(words) - 2) - len({tuple(words[i : i + 3]) for i in range(len(words) - 2)})) / max(1, len(words)),
    }


def test_features_equal_plain_python():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "b.", "c ", " ", "\n", "!", "#", "d "]) for _ in range(rng.randrange(0, 200))) for _ in range(150)]
    found = quality.features_of(pa.array(texts, pa.large_string()))
    at = {n: i for i, n in enumerate(quality.FEATURES)}
    for row, text in zip(found, texts):
        want = plain_features(text)
        assert abs(np.expm1(row[at["log_words"]]) - want["words"]) < 1e-9
        for ours, theirs in (("distinct_words", "distinct"), ("common_word", "common"), ("repeated_lines", "repeated_lines"), ("ended_lines", "ended"), ("repeated_words", "triples")):
            assert abs(row[at[ours]] - want[theirs]) < 1e-9, (ours, text)


def test_quality_on_held_out_rows_and_odd_rows(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice(["Some", "plain", "words", "that", "make", "sense."]) + str(rng.randrange(90)) for _ in range(rng.randrange(5, 80)))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW###", "a | b |", "***"]) for _ in range(rng.randrange(5, 80)))
    rows = [(d, good() if d % 5 else bad(), int(d % 5 > 0)) for d in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = docs.select("doc_id", "quality")
    model = quality.train(docs, labels.filter("doc_id % 4 <> 2").union(labels.limit(20)))
    held = quality.score(docs, model).filter("doc_id % 4 = 2").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "BUY!! " * 50_000)], "doc_id long, text string").withColumn("predicted", F.lit("mine"))
    found = quality.score(odd, model).collect()
    assert found[0].score == found[1].score and found[2].predicted == 0 and all(0 <= r.score <= 1 for r in found)
    assert quality.score(odd.limit(0), model).count() == 0
    assert quality.train(docs, labels.limit(0)).base == 0
