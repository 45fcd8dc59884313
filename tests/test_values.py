"""Statistics, tokens, quotas, rotations, prompts and batches against independent computations."""

import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import rotation, text
from armature.functions import vectors as V
from armature.functions.chance import uniform
from armature.operators import batching as B
from armature.operators import corpus as C
from armature.operators import evaluation as X
from armature.operators import images as G
from armature.operators import layout as L
from armature.operators import mixtures as M
from armature.operators import prompts as P
from armature.operators import statistics as T
from armature.operators import tokens as K
from armature.operators import unnormalize as U


def test_two_pass_statistics_equal_numpy(spark):
    rng = np.random.default_rng(0)
    n = {"a": 6000, "b": 11, "c": 1}  # one dataset holds nearly all rows
    rows = [(d, 0, rng.normal(size=3).round(3 if d == "a" else 9).tolist(), [float(i % 2)]) for d, k in n.items() for i in range(k)]
    df = spark.createDataFrame(rows, "dataset_name string, episode_id int, action array<double>, proprio array<double>")
    for accuracy in (1000, 100):
        got = T.dimension_statistics(df, accuracy=accuracy).collect()
        assert len(got) == 3 * 4
        for r in got:
            x = np.array([row[2 if r["key"] == "action" else 3][r["dim"]] for row in rows if row[0] == r["dataset_name"]])
            want = [x.mean(), x.std(), x.min(), x.max(), np.quantile(x, 0.01), np.quantile(x, 0.99)]
            assert [r[s] for s in T.STATISTICS] == pytest.approx(want, abs=1e-9)


def test_quantiles_on_request_and_their_ranks(spark):
    rng = np.random.default_rng(1)
    rows = [("a", 0, [float(x), 1.0]) for x in rng.normal(size=4000).round(2)]
    df = spark.createDataFrame(rows, "dataset_name string, episode_id int, action array<double>")
    plain = T.dimension_statistics(df, quantiles=False).collect()
    assert all(r["q01"] is None and r["q99"] is None and r["mean"] is not None for r in plain)
    values = T.long_values(df, ("action",))
    found = T.dimension_statistics(df, approximate=True).filter("key = 'action'")
    assert all(r["q01_in_bounds"] and r["q99_in_bounds"] for r in T.quantile_ranks(values, found).collect())
    wrong = found.withColumn("q01", F.col("q01") + 0.2)
    assert {r["dim"]: r["q01_in_bounds"] for r in T.quantile_ranks(values, wrong).collect()}[0] is False


def test_quantiles_with_one_heavy_value(spark):
    x = [5.0] * 9000 + list(np.linspace(0, 10, 1000))
    df = spark.createDataFrame([("g", float(v)) for v in x], "g string, v double")
    got = {r["p"]: r["quantile"] for r in T.exact_quantiles(df, ["g"], "v", (0.01, 0.5, 0.99), accuracy=500).collect()}
    assert got == {p: pytest.approx(np.quantile(x, p)) for p in (0.01, 0.5, 0.99)}


def test_missing_proprio_counts_as_zeros(spark):
    df = spark.createDataFrame([("a", 0, [1.0, 2.0])], "dataset_name string, episode_id int, action array<double>")
    stats = T.dataset_statistics(df).first()
    assert stats["proprio"]["mean"] == [0.0, 0.0] and stats["num_trajectories"] == 1


def test_normalization_zeroes_constant_dimensions_even_when_masked(spark):
    rows = [("a", 0, [float(i), 7.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "dataset_name string, episode_id int, action array<double>")
    stats = T.dataset_statistics(df)
    out = T.normalize(df, stats, "bounds", 2, 0, [True, False]).orderBy(F.col("action")[0]).collect()
    assert [r["action"] for r in out] == [[pytest.approx(v, abs=1e-7), 0.0] for v in (-1, -0.5, 0, 0.5, 1)]
    gauss = T.normalize(df, stats, "normal", 2, 0, [True, False]).collect()
    assert {r["action"][1] for r in gauss} == {7.0}
    with pytest.raises(ValueError):
        T.normalize(df, stats, "bounds", 2, 0, [True])


def test_bins_on_edges_equal_digitize(spark):
    edges = np.linspace(-1, 1, 256)
    x = np.concatenate([edges, np.nextafter(edges, -9), np.nextafter(edges, 9), np.random.default_rng(1).uniform(-1.2, 1.2, 3000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    token = A.token_of_bin(A.action_bin(F.col("x")))
    got = df.select("x", A.action_bin(F.col("x")).alias("b"), A.action_of_token(token).alias("y")).collect()
    centres = (edges[:-1] + edges[1:]) / 2
    for r in got:
        b = int(np.digitize(np.clip(r["x"], -1, 1), edges))
        assert r["b"] == b
        assert r["y"] == pytest.approx(centres[min(b - 1, 254)], abs=1e-15)
        assert abs(r["y"] - np.clip(r["x"], -1, 1)) <= 1 / 255 + 1e-12


def test_clip_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (-2.0,)], "x double")
    got = [r[0] for r in df.select(A.clip_gripper(F.col("x"))).collect()]
    assert math.isnan(got[0]) and got[1:] == [1.0, 0.0]


def quotas(spark, weights, n):
    entries = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "pos int, weight double")
    return [r["quota"] for r in M.quota_table(entries, n).orderBy("pos").collect()]


def test_quotas_sum_cover_and_follow_the_weights(spark):
    rnd = random.Random(6)
    for _ in range(25):
        weights = [rnd.choice([0.0, 1e-3, rnd.random(), 50 * rnd.random()]) for _ in range(rnd.randrange(1, 12))] + [1.0]
        n = rnd.randrange(len(weights), 400)
        quota = quotas(spark, weights, n)
        assert sum(quota) == n
        assert all((q >= 1) == (w > 0) for q, w in zip(quota, weights))
        ones = sum(q == 1 for q in quota)
        rest = sum(w for q, w in zip(quota, weights) if q > 1)
        assert all(q - 1 <= w / rest * (n - ones) + 1e-9 for q, w in zip(quota, weights) if q > 1 and rest)


def test_quota_errors_and_ties(spark):
    assert quotas(spark, [1, 1], 3) == [1, 2]  # equal remainders: the later entry first
    assert quotas(spark, [1000, 1, 1], 10) == [8, 1, 1]
    assert quotas(spark, [3, 0, 3], 7) == [3, 0, 4]
    for weights, n in (([-1, 2], 5), ([1, 1, 1], 2)):
        with pytest.raises(ValueError):
            quotas(spark, weights, n)


def test_uniform_is_the_documented_hash(spark):
    import hashlib

    got = spark.range(5).select("id", uniform(7, "id").alias("u")).collect()
    for r in got:
        assert r["u"] == int(hashlib.md5(f"7:{r['id']}".encode()).hexdigest()[:13], 16) / 2**52


def _matrix(angles):
    sx, sy, sz = np.sin(angles)
    cx, cy, cz = np.cos(angles)
    rx = np.array([[1, 0, 0], [0, cx, -sx], [0, sx, cx]])
    ry = np.array([[cy, 0, sy], [0, 1, 0], [-sy, 0, cy]])
    rz = np.array([[cz, -sz, 0], [sz, cz, 0], [0, 0, 1]])
    return rz @ ry @ rx


def _quaternion_matrix(x, y, z, w):
    return np.array(
        [
            [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
            [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
            [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
        ]
    )


def test_rotations_round_trip(spark):
    rng = np.random.default_rng(3)
    q = rng.normal(size=(40, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    h = math.sqrt(0.5)
    q = np.vstack([q, [[0, h, 0, h], [0, -h, 0, h], [0, 0, 0, 1], [1, 0, 0, 0]]])  # both poles, identity, half turn
    v = rng.normal(size=(len(q), 6))
    rows = [(q_.tolist(), v_.tolist()) for q_, v_ in zip(q, v)]
    df = spark.createDataFrame(rows, "q array<double>, v array<double>")
    c, vv = F.col("q"), F.col("v")
    out = df.select(
        "q", "v",
        F.array(*rotation.quaternion_to_euler(c[0], c[1], c[2], c[3])).alias("euler"),
        F.array(*rotation.quaternion_to_axis_angle(c[0], c[1], c[2], c[3])).alias("axis"),
        F.array(*rotation.velocity_in_wrist_frame([vv[i] for i in range(6)], [c[i] for i in range(3)])).alias("wrist"),
    ).collect()
    for r in out:
        m = _quaternion_matrix(*r["q"])
        assert np.allclose(_matrix(r["euler"]), m, atol=1e-6)
        angle = np.linalg.norm(r["axis"])
        if angle:
            k = np.array(r["axis"]) / angle
            cross = np.array([[0, -k[2], k[1]], [k[2], 0, -k[0]], [-k[1], k[0], 0]])
            assert np.allclose(np.eye(3) + math.sin(angle) * cross + (1 - math.cos(angle)) * cross @ cross, m, atol=1e-9)
        frame, turn = _matrix(r["q"][:3]), _matrix(r["v"][3:])
        back = frame.T @ turn @ frame
        assert np.allclose(r["wrist"], np.concatenate([frame.T @ r["v"][:3], back[0], back[1]]))


CHATS = {
    1: ["  <image>\nWhat is\tthis? ", " A cup.\n\n"],
    2: ["Hi", "", "More ", "Sure  "],
    3: ["Only a question <image>"],
}


def turns(spark):
    rows = [(c, t, "human" if t % 2 == 0 else "gpt", m, None if c == 2 else "x.jpg") for c, ms in CHATS.items() for t, m in enumerate(ms)]
    return spark.createDataFrame(rows, "conv_id long, turn_idx int, role string, text string, image string")


EXPECTED = {
    # (human on turn 0, human later, reply end)
    "pure": ("In: {m}\nOut: ", "In: {m}\nOut: ", "</s>"),
    "vicuna": (P.ASSISTANT_SYSTEM + " USER: {m} ASSISTANT: ", "USER: {m} ASSISTANT: ", "</s>"),
    "llama2": ("[INST] <<SYS>\n" + P.VISION_SYSTEM + "\n<</SYS>>\n\n{m} [/INST] ", "[INST] {m} [/INST] ", "</s>"),
    "mistral": ("[INST] {m} [/INST] ", "[INST] {m} [/INST] ", "</s>"),
    "phi": ("<|endoftext|>Input: {m}\nOutput: ", "Input: {m}\nOutput: ", "\n<|endoftext|>"),
}


def said(name, messages):
    first, later, end = EXPECTED[name]
    out = []
    for i, m in enumerate(messages):
        m = m.replace("<image>", "").strip()
        out.append((m or " ") + end if i % 2 else (later if i else first).format(m=m))
    return out


def test_chat_prompts(spark):
    got = {r["conv_id"]: r for r in P.chat_prompts(turns(spark), list(EXPECTED)).collect()}
    for name in EXPECTED:
        for c, messages in CHATS.items():
            assert got[c][name] == "".join(said(name, messages)).rstrip()


def test_long_chats_are_one_row_and_their_bound_an_error(spark):
    long = spark.range(1030).selectExpr("7L AS conv_id", "CAST(id AS INT) AS turn_idx", "concat('m', id) AS text")
    (row,) = P.chat_prompts(long, ["pure"]).collect()
    assert row["pure"] == "".join(said("pure", [f"m{i}" for i in range(1030)])).rstrip()
    with pytest.raises(Exception, match="more than 1000 turns"):
        P.chat_prompts(long, ["pure"], most_turns=1000).collect()


def test_chat_tokens_and_labels(spark):
    for limit in (10_000, 300, 20):
        got = {r["conv_id"]: r for r in K.chat_examples(turns(spark), "vicuna", limit).collect()}
        for c, messages in CHATS.items():
            ids, labels = [], []
            for i, piece in enumerate(said("vicuna", messages)):
                more = ([1] if i == 0 else []) + [b + 3 for b in piece.rstrip().encode()]
                ids += more
                labels += more if i % 2 else [-100] * len(more)
            labels = labels[:limit]
            if c != 2:
                labels[0] = -100
            assert got[c]["input_ids"] == ids[:limit] and got[c]["labels"] == labels


def test_captions_take_two_turns_and_an_image(spark):
    got = {r["conv_id"]: r for r in K.caption_examples(turns(spark)).collect()}
    ids = [1] + [b + 3 for b in b"A cup.</s>"]
    assert set(got) == set(CHATS) and got[1]["problem"] is None
    assert got[1]["input_ids"] == ids and got[1]["labels"] == [-100, *ids[1:]]
    assert all(r["problem"] and r["input_ids"] is None and r["labels"] is None for c, r in got.items() if c != 1)


def test_default_tokens_are_bytes_of_whole_batches(spark):
    said = ["a", "", None, "é漢😀", "x" * 3000]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i long, s string").coalesce(1)
    got = {r["i"]: r["ids"] for r in df.select("i", K.encoder()(F.col("s")).alias("ids")).collect()}
    assert got == {i: None if s is None else [b + 3 for b in s.encode()] for i, s in enumerate(said)}
    plugged = {r["i"]: r["ids"] for r in df.select("i", K.encoder(lambda t: [len(t)])(F.col("s")).alias("ids")).collect()}
    assert plugged == {i: None if s is None else [len(s)] for i, s in enumerate(said)}
    whole = K.encoder(batch=lambda texts: [[len(texts), len(t)] for t in texts])  # one call for the four texts that are there
    assert {r["i"]: r["ids"] for r in df.select("i", whole(F.col("s")).alias("ids")).collect()} == {i: None if s is None else [4, len(s)] for i, s in enumerate(said)}
    none = df.filter("s IS NULL").select(whole(F.col("s")).alias("ids")).collect()
    assert [r["ids"] for r in none] == [None]


def test_tokenizers_get_texts_in_bounded_pieces(spark):
    """Three MB of texts in one Arrow batch, a long one and a null one among them."""
    said = ["x" * 10_000] * 150 + [None, "y" * 1_500_000] + ["z" * 10_000] * 150
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i long, s string").coalesce(1)
    ids = K.encoder(batch=lambda texts: [[len(t), sum(map(len, texts))] for t in texts])(F.col("s"))
    got = {r["i"]: r["ids"] for r in df.select("i", ids.alias("ids")).collect()}
    assert {i: x and x[0] for i, x in got.items()} == {i: s and len(s) for i, s in enumerate(said)}
    assert max(x[1] for x in got.values() if x) < (1 << 20) + 1_500_000 and got[0][1] < (1 << 20) + 10_000


def test_tokenizers_without_a_first_token(spark):
    got = {r["conv_id"]: r for r in K.chat_examples(turns(spark), "phi", 10_000, bos=None).collect()}
    for c, messages in CHATS.items():
        assert got[c]["input_ids"] == [b + 3 for piece in said("phi", messages) for b in piece.rstrip().encode()]


def test_python_whitespace_rules(spark):
    samples = ["  a b \x1c", "\v\f x \x85", "", " \n ", "a<image>b  c", "　y​"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select("s", text.strip(F.col("s")).alias("t"), text.word_count(F.col("s")).alias("n")).collect()
    for r in got:
        assert r["t"] == r["s"].strip() and r["n"] == len(r["s"].split())


def test_stems_and_code_points(spark):
    from pathlib import PurePosixPath

    names = ["a/b/c.png", "x.tar.gz", "plain", "d/.hidden", "e.f/g"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(text.file_stem(F.col("n"))).collect()] == [PurePosixPath(n).stem for n in names]
    words = ["grün", "漢字 \U0001f600", ""]
    points = spark.createDataFrame([([ord(c) for c in w] + [0, 65, 0],) for w in words], "p array<int>")
    assert [r[0] for r in points.select(text.from_code_points(F.col("p"))).collect()] == words


def test_padding(spark):
    rows = [(0, [5, 0, 6], [5, -100, 6], "a"), (0, [1], [1], None), (1, [2, 3], [2, 3], "b")]
    df = spark.createDataFrame(rows, "batch_no int, input_ids array<int>, labels array<int>, image string")
    got = {tuple(r["input_ids"]): r for r in K.pad_batches(df, "batch_no", 2, pad=0).collect()}
    assert set(got) == {(5, 0), (1, 0), (2, 3)}
    assert got[(5, 0)]["attention_mask"] == [1, 0] and got[(1, 0)]["labels"] == [1, -100] and not got[(1, 0)]["has_image"]
    with pytest.raises(PySparkException):
        K.pad_batches(df, "batch_no", 2, image_required=True).collect()


def test_length_buckets_worked_example(spark):
    lengths = [20, 90, 21, 22, 91, 18, 89, 19, 93, 88, 92, 17]
    batches = [[4, 3, 0, 5], [6, 9, 7, 11], [8, 10, 1, 2]]
    rows = [(True, b, s, i, lengths[i]) for b, ids in enumerate(batches) for s, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "is_multimodal boolean, batch_no long, slot int, example_id long, n_words long")
    got = B.length_buckets(df, 2).orderBy("batch_no", "slot").collect()
    for b, ids in enumerate(batches):
        weight, buckets = [0, 0], [[], []]
        for i in ids:
            k = 0 if weight[0] <= weight[1] else 1
            buckets[k].append(i)
            weight[k] = math.inf if len(buckets[k]) == 2 else weight[k] + lengths[i]
        assert [r["example_id"] for r in got if r["batch_no"] == b] == buckets[0] + buckets[1]
    assert [r["example_id"] for r in got if r["batch_no"] == 0] == [4, 5, 3, 0]


def test_batch_plan_covers_everything(spark):
    rows = [(i, i % 3 > 0, 1 + i * 37 % 101) for i in range(203)]
    examples = spark.createDataFrame(rows, "example_id long, is_multimodal boolean, n_words long")
    batches = B.modality_batches(examples, 16, 3)
    report = B.cover_report(batches, examples, 16, 4).first()
    assert report["complete"] and report["divides_batches"] and report["divides_replicas"] and report["n_rows"] == 144 + 80
    got = batches.collect()
    for key in {(r["is_multimodal"], r["batch_no"]) for r in got}:
        batch = sorted((r for r in got if (r["is_multimodal"], r["batch_no"]) == key), key=lambda r: r["slot"])
        assert len(batch) == 16 and [r["n_words"] for r in batch] == sorted((r["n_words"] for r in batch), reverse=True)
    order = B.batch_order(batches, 3)
    placed = {(r["is_multimodal"], r["batch_no"]): r for r in order.collect()}
    assert sorted(r["epoch_batch"] for r in placed.values()) == list(range(14))
    first = next(r for r in placed.values() if r["epoch_batch"] == 0)
    assert first["longest"] == max(r["longest"] for r in placed.values())
    ranks = B.replica_slices(batches, order, 16, 4).groupBy("rank").count().collect()
    assert {r["count"] for r in ranks} == {224 // 4}


def test_distributed_sample_wraps(spark):
    df = spark.range(10).withColumnRenamed("id", "example_id")
    got = B.distributed_sample(df, 4, 1).collect()
    assert len(got) == 12 and {r["example_id"] for r in got} == set(range(10))
    with pytest.raises(ValueError):
        B.epoch_seed(2**32, 0)


def test_mixture_rules(spark):
    mix = spark.createDataFrame([(0, "a", 1.0), (1, "b", 0.5), (2, "a", 9.0), (3, "z", 1.0)], "pos int, dataset_name string, weight double")
    sizes = spark.createDataFrame([("a", 100), ("b", 300)], "dataset_name string, num_transitions long")
    kept, skipped = M.select_mixture(mix, sizes)
    assert [r["dataset_name"] for r in skipped.collect()] == ["z"]
    weights = M.mixture_weights(kept, sizes)
    assert {r["dataset_name"]: r["sample_weight"] for r in weights.collect()} == {"a": pytest.approx(0.4), "b": pytest.approx(0.6)}
    assert M.effective_length(weights).first()[0] == 250
    with pytest.raises(PySparkException):
        M.effective_length(weights.filter("dataset_name = 'b'")).collect()


def test_sampled_epoch(spark):
    frames = spark.createDataFrame([("a", i) for i in range(7)] + [("b", i) for i in range(200)], "dataset_name string, frame long")
    weights = spark.createDataFrame([(0, "a", 0.5, 7), (1, "b", 0.5, 200)], "pos int, dataset_name string, sample_weight double, num_transitions long")
    got = M.sample_frames(frames, ["frame"], weights, 100, 9).collect()
    assert sorted(r["p"] for r in got) == list(range(100))
    a = sorted((r for r in got if r["dataset_name"] == "a"), key=lambda r: r["p"])
    assert [r["k"] for r in a] == [r["epoch"] * 7 + r["idx"] for r in a] == list(range(len(a)))
    for e in range(len(a) // 7):
        assert {r["frame"] for r in a[e * 7 : e * 7 + 7]} == set(range(7))


def test_missing_images_and_format_plan(spark):
    refs = spark.createDataFrame([(1,)] * 5 + [(2,)], "image_id long")
    files = spark.createDataFrame([(2,)], "page_id long")
    assert [tuple(r) for r in C.missing_images(refs, "image_id", files, "page_id").collect()] == [(1, 5)]
    names = ["a.jpg", "a.png", "b.gif", "c.png", "d.jpeg", "e.tif"]
    plan = C.image_format_plan(spark.createDataFrame([(n,) for n in names], "name string"), "name")
    assert {r["name"]: r["action"] for r in plan.collect()} == dict(
        zip(names, ["keep", "skip", "convert first frame", "convert", "keep", "error"])
    )


def test_unnormalize_keys(spark):
    stats = spark.createDataFrame([("a", ([0.0], [2.0])), ("b_no_noops", ([0.0], [4.0]))], "dataset_name string, action struct<q01:array<double>,q99:array<double>>")
    asked = lambda *k: spark.createDataFrame([(x, [0.5]) for x in k], "unnorm_key string, v array<double>")
    out = U.unnormalize(U.resolve_keys(asked("a", "b"), stats), "v", 1).orderBy("unnorm_key").collect()
    assert [(r["resolved_key"], r["unnormalized"]) for r in out] == [("a", [1.5]), ("b_no_noops", [3.0])]
    for wanted in ("c", None):
        with pytest.raises(PySparkException):
            U.resolve_keys(asked(wanted), stats).collect()
    only = U.resolve_keys(asked(None), stats.filter("dataset_name = 'a'")).collect()
    assert only[0]["resolved_key"] == "a"


def test_layout_contracts(spark):
    df = spark.createDataFrame([("a", 0, 0, [1.0, 2.0])], "dataset_name string, episode_id int, timestep int, action array<double>")
    with pytest.raises(ValueError):
        L.restructure(df, {"primary": None})
    with pytest.raises(PySparkException):
        L.with_absolute_mask(df, [True]).collect()
    flags = df.withColumn("s", F.struct(F.lit(True).alias("flag")))
    with pytest.raises(ValueError):
        L.map_tree(F.col("s"), flags.schema["s"].dataType, lambda _, v, kind: L.padding_of(v, kind))


def test_pixel_job_undoes_itself(spark):
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 256, size=(20, 4, 6, 3), dtype=np.uint8)
    rows = [(i, 4, 6, bytearray(x.tobytes())) for i, x in enumerate(raw)]
    df = spark.createDataFrame(rows, "id long, height int, width int, data binary")
    got = {r["id"]: np.array(r["pixels"]).reshape(r["height"], r["width"], 3) for r in G.pixel_job(df, "id", rotate=True).collect()}
    for i, x in enumerate(raw):
        back = got[i][::-1, ::-1] * np.array(G.STD) + np.array(G.MEAN)
        assert np.allclose(back * 255, x, atol=1e-3)
    cut = G.pixel_job(df, "id", crop=(1, 2, 2, 3), pad=1, fill=9, normalize=False).collect()
    assert {(r["height"], r["width"]) for r in cut} == {(4, 5)}
    assert np.allclose(np.array(cut[0]["pixels"]).reshape(4, 5, 3)[0], 9 / 255)


def test_metric_masks(spark):
    rows = [("a", 0, [5, 31800, 2], [-100, 31801, 31900])]
    df = spark.createDataFrame(rows, "dataset_name string, step int, pred array<int>, labels array<int>")
    pairs = X.token_pairs(df, ["dataset_name", "step"], "pred", "labels").collect()
    assert [(r["pred"], r["gt"]) for r in pairs] == [(5, 31801), (31800, 31900)]


def test_probabilities(spark):
    df = spark.createDataFrame([([1000.0, 1001.0, 3.0],)], "s array<double>")
    got = df.select(K.choice_probabilities(F.col("s"), [0, 1])).first()[0]
    assert got == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)])


def test_slug_and_prompt(spark):
    s = "Put the.Red\nCup " + "x" * 60
    df = spark.createDataFrame([(s,)], "s string")
    want = s.lower().replace(" ", "_").replace("\n", "_").replace(".", "_")[:50]
    assert df.select(text.task_slug(F.col("s"))).first()[0] == want
    plain, chat = df.select(P.action_prompt(F.lit("Lift IT"), F.lit("m/7b")), P.action_prompt(F.lit("Lift IT"), F.lit("m/v01"))).first()
    assert plain == "In: What action should the robot take to lift it?\nOut:"
    assert chat.endswith("USER: What action should the robot take to lift it? ASSISTANT:") and re.match("A chat", chat)
