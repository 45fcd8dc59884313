"""Toxic passages as maximum-scoring segments of token log-odds.

Token weights are log-odds of the toxic against the clean labelled texts, shrunk by a Dirichlet prior: a base for every token
and a part in proportion to its counts in both. A token counts once per text and a copied text once, so that no single text
makes a term. Tokens whose weight is so many standard errors from zero that chance would give `false_terms` of them count with
it, positive or negative; the others count zero. From which weight on positive ones count is settled on the sample itself: terms
of one half are judged by the other. A drift is taken from every token so that clean text scores negative on average. A linear
scan finds all maximal segments of positive score (Ruzzo and Tompa). Scores of segments in random clean text follow an extreme-value law: an S in a text of n tokens is expected
K n exp(-lambda S) times by chance, with lambda from the clean token frequencies and K from clean texts. The segments of a
text are put together by the sum statistic of that law, and a logistic curve on the sample makes it a probability.

Between two gains the score only falls, so the scan walks over the gains of a text; sums and terms are found for a whole batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import textkit
from armature.operators.smallside import cut_lineage


@dataclass(frozen=True)
class Bounds:
    """The bounded labelled sample and the size of the term list. Everything else covers all rows."""

    rows: int = 20_000
    terms: int = 50_000


@dataclass(frozen=True)
class Settings:
    prior: float = 200.0
    base: float = 0.5
    false_terms: float = 50.0
    least_weight: float | None = None  # of positive terms; None: the one of BARS that judges the other half of the sample best
    highest_weight: float = 8.0
    drift: float = 0.3
    significant: float = 0.05


#: Log-odds that a positive term may be asked to have.
BARS = (0.0, 1.0, 2.0, 3.0, 4.0)


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # sorted token hashes
    weights: np.ndarray  # weight of each, without the drift
    drift: float
    decay: float  # lambda
    log_k: float
    slope: float
    offset: float


def maximal_segments(place: np.ndarray, gain: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a text, in linear time.

    `place` are the positions of the terms and `gain` their scores; every other token scores -drift.
    """
    segments: list[list] = []  # first, last, sum before it, sum up to its end, next segment to the left with a smaller start
    before = np.cumsum(gain) - gain - drift * (place - np.arange(len(place)))
    up = np.flatnonzero(gain > 0)  # between two gains the sum only falls
    for p, left, right in zip(place[up].tolist(), before[up].tolist(), (before + gain)[up].tolist(), strict=True):
        first = p
        k = len(segments) - 1
        while True:
            while k >= 0 and segments[k][2] >= left:
                k = segments[k][4]
            if k < 0 or segments[k][3] >= right:
                segments.append([first, p, left, right, k])
                break
            first, left = segments[k][0], segments[k][2]
            back = segments[k][4]
            del segments[k:]
            k = back
    return [(s[0], s[1], s[3] - s[2]) for s in segments]


def tokens(texts: pa.Array) -> tuple[textkit.Words, np.ndarray]:
    data, starts = textkit.raw_bytes(texts)
    return textkit.Words(data, starts, textkit.letters_and_digits(), textkit.ascii_lower()), data


def passages(texts: pa.Array, hashes: np.ndarray, weights: np.ndarray, drift: float) -> tuple[np.ndarray, list[list[tuple[int, int, float]]], textkit.Words]:
    """Tokens per text, and the maximal segments of each text."""
    words, _ = tokens(texts)
    size = np.diff(words.first)
    found: list[list[tuple[int, int, float]]] = [[] for _ in range(len(texts))]
    if len(hashes) and len(words):
        spot = np.minimum(np.searchsorted(hashes, words.hash), len(hashes) - 1)
        hit = np.flatnonzero(hashes[spot] == words.hash)
        owner = words.text_index()[hit]
        edge = np.searchsorted(owner, np.arange(len(texts) + 1))
        for t in np.unique(owner):
            part = hit[edge[t] : edge[t + 1]]
            found[t] = maximal_segments(part - words.first[t], weights[spot[part]] - drift, drift)
    return size, found, words


def evidence(size: float, scores: list[float], decay: float, log_k: float, significant: float = Settings.significant) -> float:
    """Minus log of the chance that clean text of this length has segments as good: the best r of them together, least over
    r, with a factor r for the choice. Segments that are expected `significant` times or more by chance count for nothing."""
    normal = sorted((decay * s - log_k - math.log(max(1.0, size)) for s in scores), reverse=True)
    best, total = 0.0, 0.0
    for r, x in enumerate(normal, 1):
        total += x
        if x <= -math.log(significant):
            break
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r) - math.log(r))
    return best


def score_of(model: Model, size: np.ndarray, found: list[list[tuple[int, int, float]]]) -> np.ndarray:
    e = np.array([evidence(n, [s[2] for s in f], model.decay, model.log_k) for n, f in zip(size, found, strict=True)])
    return 1 / (1 + np.exp(-np.clip(model.slope * e + model.offset, -40, 40)))


# ---- fitting --------------------------------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "toxic", bounds: Bounds = Bounds(), settings: Settings = Settings()) -> Model:
    """Fit on the labelled rows whose hash is least, at most `bounds.rows`; its texts are written once to the checkpoint folder.

    Rows without a label or id take no part; an id with several labels has the highest. One class only, or no rows, gives a
    model without terms that scores every text with the rate of the class.
    """
    one = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    draw = F.xxhash64(F.lit("toxicity sample"), "id")
    known = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    chosen = one.join(known.select("id").distinct(), "id").orderBy(draw, "id").limit(bounds.rows)
    sampled = known.join(F.broadcast(chosen), "id").groupBy(F.xxhash64("text").alias("copy")).agg(F.max("label").alias("label"), F.first("text").alias("text"))
    sample = cut_lineage(
        sampled.select(F.greatest(F.lit(0), F.least(F.lit(1), "label")).cast("int").alias("label"), "text", F.pmod("copy", F.lit(2)).alias("half"))
    )
    texts = sample.select("label", "text")
    clean, toxic, terms = _terms(texts, bounds, settings)
    rate = (toxic + 0.5) / (clean + toxic + 1)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), settings.drift, 1.0, 0.0, 1.0, math.log(rate / (1 - rate)))
    bar = _bar(sample, bounds, settings) if settings.least_weight is None else settings.least_weight
    found = None if terms is None else terms.above(bar, settings)
    return nothing if found is None else _fitted(found, _sample_evidence(texts, *found[:2], found[3]))


@dataclass(frozen=True)
class Terms:
    """Tokens whose log-odds are surely not zero: weight, and share of the clean tokens that they are."""

    hashes: np.ndarray
    weights: np.ndarray
    share: np.ndarray

    def above(self, bar: float, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, float] | None:
        """Hashes, weights, shares and drift with the positive terms of at least `bar` and all negative ones."""
        taken = (self.weights < 0) | (self.weights >= bar)
        if not taken.any():
            return None
        weights, share = self.weights[taken], self.share[taken]
        drift = max(settings.drift, 2.0 * float((share * weights).sum()))
        return (self.hashes[taken], weights, share, drift) if weights.max() > drift else None


def _terms(texts: DataFrame, bounds: Bounds, settings: Settings) -> tuple[int, int, Terms | None]:
    """Clean texts, toxic texts, and the terms of both; none if there is one class only."""
    counted = token_counts(texts)
    rows = {r["label"]: (r["n"], r["t"]) for r in counted.groupBy("label").agg(F.sum("texts").alias("n"), F.sum("n").alias("t")).collect()}
    clean, toxic = rows.get(0, (0, 0)), rows.get(1, (0, 0))
    if not clean[1] or not toxic[1]:
        return clean[0], toxic[0], None
    counts = counted.filter("token is not null").groupBy("token").pivot("label", [0, 1]).sum("n").na.fill(0).select("token", F.col("0").cast("double").alias("c"), F.col("1").cast("double").alias("t"))
    both = float(clean[1] + toxic[1])
    prior = settings.base + settings.prior * (F.col("c") + F.col("t")) / both
    odds = lambda n, total: F.log((F.col(n) + prior) / (F.lit(float(total) + settings.prior) - F.col(n) - prior))
    weighed = counts.withColumn("w", odds("t", toxic[1]) - odds("c", clean[1])).withColumn("z", F.col("w") / F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior)))
    least = NormalDist().inv_cdf(max(0.5, 1 - settings.false_terms / max(1, counts.count())))
    terms = weighed.filter(F.abs("z") >= least).orderBy(F.desc(F.abs("z")), "token").limit(bounds.terms).toPandas()
    hashes = terms["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    weights = np.clip(terms["w"].to_numpy(float), -settings.highest_weight, settings.highest_weight)
    share = (terms["c"].to_numpy(float) + 0.5) / (clean[1] + 0.5 * max(1, len(terms)))
    return clean[0], toxic[0], Terms(hashes[order], weights[order], share[order])


def _fitted(terms: tuple[np.ndarray, np.ndarray, np.ndarray, float], found: list[tuple[int, int, list[float]]]) -> Model:
    """The extreme-value law and the logistic curve of these terms on texts with known labels."""
    hashes, weights, share, drift = terms
    decay = _decay(share, weights - drift, drift)
    log_k = _log_k(found, decay)
    slope, offset = _logistic(np.array([evidence(n, s, decay, log_k) for _, n, s in found]), np.array([x for x, _, _ in found], float))
    return Model(hashes, weights, drift, decay, log_k, slope, offset)


def _bar(sample: DataFrame, bounds: Bounds, settings: Settings) -> float:
    """The bar whose model of one half of the sample has the least log loss on the other half; the lowest of equals."""
    learnt, judged = (sample.filter(F.col("half") == h).select("label", "text") for h in (0, 1))
    _, _, terms = _terms(learnt, bounds, settings)
    best, least = BARS[0], math.inf
    for bar in BARS:
        found = None if terms is None else terms.above(bar, settings)
        if found is None:
            continue
        model = _fitted(found, _sample_evidence(learnt, *found[:2], found[3]))
        rows = _sample_evidence(judged, *found[:2], found[3])
        score = np.clip(score_of(model, np.array([n for _, n, _ in rows]), [[(0, 0, x) for x in s] for _, _, s in rows]), 1e-6, 1 - 1e-6)
        label = np.array([x for x, _, _ in rows], float)
        loss = float(-(label * np.log(score) + (1 - label) * np.log(1 - score)).mean()) if len(rows) else 0.0
        if loss < least - 1e-12:
            best, least = bar, loss
    return best


def _arrow_rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def token_counts(sample: DataFrame) -> DataFrame:
    """(label, token, n, texts): texts that hold a token, added up per slice of a batch; a row without a token counts the texts
    of the slice. Sum them by label and token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high, texts in textkit.parts(batch.column(1)):
                words, _ = tokens(texts)
                owner = words.text_index()
                order = np.lexsort((words.hash, owner))
                token, owner = words.hash[order], owner[order]
                once = np.ones(len(token), bool)
                once[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
                token, kind = token[once], label[low:high][owner[once]]
                for value in (0, 1):
                    found, n = np.unique(token[kind == value], return_counts=True)
                    names = pa.concat_arrays([pa.array(found.view(np.int64)), pa.nulls(1, pa.int64())])
                    texts_here = np.append(np.zeros(len(found), np.int64), int((label[low:high] == value).sum()))
                    yield _arrow_rows(["label", "token", "n", "texts"], np.full(len(found) + 1, value, np.int32), names, np.append(n, 0).astype(np.int64), texts_here)

    return sample.mapInArrow(count, "label int, token long, n long, texts long")


def _decay(share: np.ndarray, gain: np.ndarray, drift: float) -> float:
    """The positive root of sum p exp(lambda s) = 1 over clean tokens."""
    rest = max(0.0, 1 - float(share.sum()))
    excess = lambda x: float((share * np.exp(x * gain)).sum()) + rest * math.exp(-x * drift) - 1
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _sample_evidence(sample: DataFrame, hashes: np.ndarray, weights: np.ndarray, drift: float) -> list[tuple[int, int, list[float]]]:
    """(label, tokens, segment scores) of the sample, at most `Bounds.rows` rows."""
    shared = sample.sparkSession.sparkContext.broadcast((hashes, weights))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in textkit.parts(batch.column(1)):
                size, found, _ = passages(texts, *shared.value, drift)
                scores = pa.array([[s[2] for s in f] for f in found], pa.list_(pa.float64()))
                yield _arrow_rows(["label", "tokens", "scores"], batch.column(0).slice(low, high - low), size.astype(np.int64), scores)

    rows = sample.mapInArrow(scan, "label int, tokens long, scores array<double>").collect()
    return sorted((r.label, r.tokens, sorted(r.scores, reverse=True)) for r in rows)


def _log_k(found: list[tuple[int, int, list[float]]], decay: float) -> float:
    """Most likely K given the best segment of each clean text: P(best < S) = exp(-K n exp(-lambda S)).

    A text without a segment says only that its best is below every score, which is taken as zero."""
    clean = [(max(1, n), s[0] if s else 0.0) for label, n, s in found if label == 0]
    rate = sum(n * math.exp(-decay * s) for n, s in clean)
    hits = sum(1 for _, s in clean if s > 0)
    return math.log((hits + 0.5) / max(rate, 1e-9))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, with a small ridge and labels drawn in a little."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 0.0, math.log((n1 + 0.5) / (n0 + 0.5))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -40, 40)))
        h = np.maximum(p * (1 - p), 1e-9)
        g1, g0 = ((target - p) * x).sum() - 1e-3 * slope, (target - p).sum()
        a, b, c = (h * x * x).sum() + 1e-3, (h * x).sum(), h.sum()
        det = a * c - b * b
        if det <= 1e-12:
            break
        d1, d0 = (c * g1 - b * g0) / det, (a * g0 - b * g1) / det
        d1, d0 = float(np.clip(d1, -2, 2)), float(np.clip(d0, -2, 2))
        slope, offset = slope + d1, offset + d0
        if abs(d1) + abs(d0) < 1e-10:
            break
    return max(slope, 1e-6), offset


# ---- use ------------------------------------------------------------------------------------------------------------

PASSAGE = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())]))


def detect(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7, significant: float = Settings.significant, keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with `score`, `predicted` and `passages`: the segments expected fewer than `significant` times in clean
    text of that length, in order, as byte ranges of the text with their score and expected number.

    Null and empty texts have no passage and the lowest score. A result column replaces an input column of its name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers may lack this package

    def compute(texts: pa.Array) -> list[pa.Array | np.ndarray]:
        m = Model(**shared.value)
        size, found, words = passages(texts, m.hashes, m.weights, m.drift)
        score = score_of(m, size, found)
        _, starts = textkit.raw_bytes(texts)
        spans = []
        for t, segments in enumerate(found):
            base, out = words.first[t], []
            for a, b, s in segments:
                expected = math.exp(min(50.0, m.log_k - m.decay * s)) * max(1, size[t])
                if expected < significant:
                    out.append({"start": int(words.start[base + a] - starts[t]), "stop": int(words.end[base + b] - starts[t]), "score": s, "expected": expected})
            spans.append(out)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
        return [score, (score >= threshold).astype(np.int32), pa.array(spans, kind)]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("passages", PASSAGE)]
    return textkit.with_text_columns(docs, text, fields, compute, keep)
