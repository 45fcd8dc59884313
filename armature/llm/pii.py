"""Personal data: generators propose overlapping spans, boosted trees score them, calibrated thresholds select.

Strict patterns give the base spans, which always stay. Generators of high recall propose many more, overlapping ones: every run
of neighbouring number groups that could be an address, a card or a telephone number, whatever separates them, and every
place that could be a mail address, spelled-out ones too. Each candidate has features of its format (digits, groups,
separators, check sum, letters beside it) and of its context (the words before and after it, by their log-odds in the sample,
and what else the text holds). Trees are fitted on candidates of a bounded sample of documents. Nobody has labelled spans, so the
labels are weak: a candidate is personal if its own characters fulfil the strict pattern, it stands free and no longer candidate
does; to teach the trees other spellings and data that stand side by side, each sampled text is also read with these spans
rewritten, with them gathered in one place, and with look-alikes instead of them, all of which are labelled as none. Scores are calibrated on texts that the trees have not seen, and per kind the threshold is the least probability at which the
accepted candidates there are precise enough. Of overlapping accepted candidates the most probable stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import boosting, textkit

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: Strict patterns. All but the mail address lie in one run of digits and the characters that may join them (`ZONE`), which is
#: looked for first. Possessive runs and look-behinds keep the search linear and change no match.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ZONE = re.compile(r"[+0-9][\x20().0-9+-]*")
STRICT_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
STRICT_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
STRICT_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

GROUP = re.compile(r"[0-9]+")
#: Spelled mail addresses, and addresses with marked dots.
SPELLED = re.compile(r"(?i)[\w.%+-]{1,64}(?:\s?[\[({]at[\])}]\s?|\sat\s|\s?@\s?)[\w-]{1,63}(?:(?:\s?[\[({]dot[\])}]\s?|\sdot\s|\.)[\w-]{1,63}){1,8}")
DOT = re.compile(r"(?i)[\s\[({]dot[\s\])}]")
MARKED_IP = re.compile(r"[0-9]{1,3}(?:\s?[\[({](?:\.|dot)[\])}]\s?[0-9]{1,3}){3}(?![0-9])")
#: Number groups of one candidate, and characters between two of them.
MOST_GROUPS, MOST_BETWEEN = 8, 3


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def fulfils(kind: int, text: str) -> bool:
    """The check on what a strict pattern matched."""
    if kind == IP:
        return all(small_number(p) for p in text.split("."))
    if kind == CARD:
        digits = digits_of(text)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == PHONE:
        return 9 <= len(digits_of(text)) <= 15
    return True


def mail_spans(text: str) -> Iterator[tuple[int, int]]:
    """Strict mail addresses: from every @, the name to its left (not into the match before) and the domain to its right."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str, zones: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strict patterns, leftmost and non-overlapping per kind; what fails its check is dropped."""
    out = [(a, EMAIL, b) for a, b in mail_spans(text)]
    for low, high in zones_of(text) if zones is None else zones:
        for kind, pattern in ((IP, STRICT_IP), (CARD, STRICT_CARD), (PHONE, STRICT_PHONE)):
            for m in pattern.finditer(text, low, high):
                if fulfils(kind, m.group()):
                    out.append((m.start(), kind, m.end()))
    return sorted(out)


def zones_of(text: str) -> list[tuple[int, int]]:
    """Runs that may hold a number of interest: the shortest, an address, has seven characters."""
    return [m.span() for m in ZONE.finditer(text) if m.end() - m.start() >= 7]


def candidates(text: str, zones: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) that the generators propose, in order, once each. The number grows with the text, not with its square."""
    out = {(a, EMAIL, b) for a, b in mail_spans(text)}
    if "@" in text or DOT.search(text):
        out |= {(m.start(), EMAIL, m.end()) for m in SPELLED.finditer(text)}
    if any(x in text for x in ("[.", "(.", "{.", "[dot", "(dot", "{dot")):
        out |= {(m.start(), IP, m.end()) for m in MARKED_IP.finditer(text)}
    for low, high in zones:
        groups = [m.span() for m in GROUP.finditer(text, low, high)]
        for i, (start, _) in enumerate(groups):
            total = 0
            for j in range(i, min(i + MOST_GROUPS, len(groups))):
                if j > i and groups[j][0] - groups[j - 1][1] > MOST_BETWEEN:
                    break
                end = groups[j][1]
                total += end - groups[j][0]
                if total > 19:
                    break
                if j - i == 3 and all(b - a <= 3 for a, b in groups[i : j + 1]):
                    out.add((start, IP, end))
                if 12 <= total:
                    out.add((start, CARD, end))
                if 9 <= total <= 15:
                    begin = start
                    while begin > max(0, start - 2) and text[begin - 1] in "+(":
                        begin -= 1
                    out.add((begin, PHONE, end))
    return sorted(out)


# ---- features -------------------------------------------------------------------------------------------------------

FEATURES = (
    "kind", "length", "digits", "groups", "shortest", "longest", "first_group", "last_group", "spaces", "dots", "dashes", "brackets", "other_marks",
    "even_marks", "plus", "luhn", "small_groups", "leading_zero", "different_digits", "letter_before", "letter_after", "digit_near_before", "digit_near_after",
    "spelled_at", "spelled_dot", "last_label", "ascii", "upper", "odds_before", "odds_after", "mails_in_text", "zones_in_text",
)


def words_beside(text: str, start: int, end: int) -> tuple[str, str]:
    """The words before and after a span, looked for in the 24 characters on either side."""
    before, after = text[max(0, start - 24) : start].split(), text[end : end + 24].split()
    return (before[-1].lower() if before else ""), (after[0].lower() if after else "")


def features_of(text: str, span: tuple[int, int, int], mails: int, zones: int) -> list[float]:
    """All features but the two log-odds, which stand in as 0."""
    start, kind, end = span
    said = text[start:end]
    groups = GROUP.findall(said)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    between = [c for c in said if not c.isalnum()]
    last = re.split(r"[.\s\])}]+", said)[-1]
    near = lambda part: any("0" <= c <= "9" for c in part)
    return [
        kind, min(end - start, 100), len(digits), len(groups), min(sizes), max(sizes), sizes[0], sizes[-1], said.count(" "), said.count("."), said.count("-"),
        sum(said.count(c) for c in "()[]{}"), sum(1 for c in between if c not in " .-()[]{}+@"), len(set(between) - set("+()@")), said.startswith("+") or text[max(0, start - 1) : start] == "+",
        bool(digits) and luhn(digits), bool(groups) and all(small_number(g) for g in groups), digits.startswith("0"), len(set(digits)),
        text[start - 1 : start].isalpha() and start > 0, text[end : end + 1].isalpha(), near(text[max(0, start - 3) : start]), near(text[end : end + 3]),
        bool(re.search(r"(?i)[\s\[({]at[\s\])}]", said)), bool(re.search(r"(?i)[\s\[({]dot[\s\])}]", said)), len(last) if last.isalpha() else 0, said.isascii(), any(c.isupper() for c in said),
        0.0, 0.0, min(mails, 20), min(zones, 20),
    ]


def weak_labels(text: str, spans: list[tuple[int, int, int]]) -> list[bool]:
    """Whether a candidate's own characters fulfil the strict pattern, it stands free, and none that contains it does so too."""
    whole = {IP: STRICT_IP, CARD: STRICT_CARD, PHONE: STRICT_PHONE}

    def alone(start: int, kind: int, end: int) -> bool:
        if text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum():
            return False
        said = text[start:end]
        if kind == EMAIL:
            return list(mail_spans(said)) == [(0, end - start)]
        found = whole[kind].match(said)
        return bool(found) and found.end() == len(said) and fulfils(kind, said)

    good = [alone(*s) for s in spans]
    widest: dict[int, int] = {}  # per kind: how far a good candidate that begins earlier, or here and longer, reaches
    out = [False] * len(spans)
    for i in sorted(range(len(spans)), key=lambda i: (spans[i][0], -spans[i][2])):
        _, kind, end = spans[i]
        if good[i]:
            out[i] = end > widest.get(kind, -1)
            widest[kind] = max(widest.get(kind, -1), end)
    return out


def rewritten(text: str, spans: list[tuple[int, int, int]], draw: int) -> tuple[str, set[tuple[int, int, int]]]:
    """The text with the spans in another spelling, chosen by `draw`, and where they now are."""
    out, places, at, size = [], set(), 0, 0
    for n, (start, kind, end) in enumerate(spans):
        if start < at:
            continue
        said, way = text[start:end], (draw + n) % 4
        groups = GROUP.findall(said)
        if kind == EMAIL:
            name, _, domain = said.partition("@")
            said = (f"{name} at {domain.replace('.', ' dot ')}", f"{name} (at) {domain.replace('.', ' (dot) ')}", f"{name}[at]{domain.replace('.', '[dot]')}", f"{name} @ {domain}")[way]
        elif kind == IP:
            said = ("[.]", "[dot]", "(.)", " (dot) ")[way].join(groups)
        elif kind == CARD:
            digits = "".join(groups)
            said = (".", "  ", " - ", ".")[way].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            lead, rest = groups[0], groups[1:]
            if len("".join(rest)) < 9:
                rest = groups
            said = ("-".join(rest), ".".join(rest), f"({rest[0]}) {'-'.join(rest[1:])}" if len(rest) > 1 else rest[0], " ".join(["00" + lead, *groups[1:]]))[way]
        out += [text[at:start], said]
        size += start - at
        places.add((size, kind, size + len(said)))
        size, at = size + len(said), end
    return "".join(out) + text[at:], places


def gathered(text: str, spans: list[tuple[int, int, int]], draw: int) -> tuple[str, set[tuple[int, int, int]]]:
    """The text with all these spans, each twice, side by side where the first was: strict patterns run over such borders."""
    turn = draw % len(spans)
    said = [(kind, text[a:b]) for a, kind, b in spans]
    said = said[turn:] + said[:turn] + said[::-1]
    at, places = spans[0][0], set()
    for kind, x in said:
        places.add((at, kind, at + len(x)))
        at += len(x) + 1
    return text[: spans[0][0]] + " ".join(x for _, x in said) + text[max(b for *_, b in spans) :], places


def spoiled(text: str, spans: list[tuple[int, int, int]], draw: int) -> str:
    """The text with look-alikes in place of the spans: check digits that fail, parts that are too large, mixed separators,
    dates, versions, lists of numbers, names without a domain."""
    out, at = [], 0
    for n, (start, kind, end) in enumerate(spans):
        if start < at:
            continue
        way = (draw + n) % 4
        groups = GROUP.findall(text[start:end])
        digits = "".join(groups)
        if kind == EMAIL:
            name = text[start:end].partition("@")[0]
            said = (f"{name}@", f"{name} at home. dot", f"@{name}", f"{name} at ten.twelve")[way]
        elif kind == IP:
            a, b, c, d = (g[-3:] for g in groups)
            said = (f"{a}.{b}.{c} {d}", f"{a} {b} {c} {d}", ".".join(f"{999 - int(g)}" for g in (a, b, c, d)), f"{a}. {b}. {c}. {d}.")[way]
        elif kind == CARD:
            wrong = digits[:-1] + str((int(digits[-1]) + 1 + draw % 9) % 10)
            said = (wrong, "  ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), " ".join(wrong[i : i + 3] for i in range(0, len(wrong), 3)), wrong + digits[:3])[way]
        else:
            year, rest = 1990 + int(digits[-2:]) % 40, digits[-4:]
            said = (f"{year}-0{1 + int(rest[0]) % 9}-1{rest[1]} 1{rest[2]}.3{rest[3]}", " ".join(digits), f"{digits[:2]} {digits[2:5]} {digits[5:]}", f"{year}.{rest[:2]}.{rest[2:]} - {year + 1}")[way]
        out += [text[at:start], said]
        at = end
    return "".join(out) + text[at:]


# ---- model ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    """The bounded sample that the trees are fitted on. Everything else covers all rows."""

    documents: int = 20_000
    candidates: int = 60_000
    words: int = 2_000


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees | None = None
    before: dict[str, float] = field(default_factory=dict)  # log-odds of the word before, and of the one after
    after: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)  # of the probability, per kind; above 1: no candidate of the kind

    def probability(self, rows: np.ndarray, before: list[str], after: list[str]) -> np.ndarray:
        rows = _with_odds(rows, before, after, self.before, self.after)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(rows) + self.offset, -40, 40)))


def _with_odds(rows: np.ndarray, before: list[str], after: list[str], odds_before: dict, odds_after: dict) -> np.ndarray:
    rows = rows.copy()
    rows[:, FEATURES.index("odds_before")] = [odds_before.get(w, 0.0) for w in before]
    rows[:, FEATURES.index("odds_after")] = [odds_after.get(w, 0.0) for w in after]
    return rows


def word_odds(words: list[str], labels: np.ndarray, most: int, prior: float = 20.0) -> dict[str, float]:
    """Log-odds of the label beside each of the `most` most frequent words, shrunk towards none."""
    n, good = Counter(words), Counter(w for w, y in zip(words, labels, strict=True) if y)
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    odds = lambda p: log(p / (1 - p))
    return {w: odds((good[w] + prior * rate) / (c + prior)) - odds(rate) for w, c in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:most]}


SAMPLE = T.StructType(
    [
        T.StructField("id_hash", T.LongType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)


def _sample_rows(text: str, draw: int) -> Iterator[tuple[int, str, str, list[float]]]:
    """Candidates of a text, of the text with other spellings and of the one with its data side by side, with weak labels."""
    zones = zones_of(text)
    spans = candidates(text, zones)
    labels = weak_labels(text, spans)
    readings = [(text, {s for s, good in zip(spans, labels, strict=True) if good})]
    known: list[tuple[int, int, int]] = []  # what the other readings change, the strict patterns' finds and those they run over
    for span in sorted(readings[0][1]):
        if not known or span[0] >= known[-1][2]:
            known.append(span)
    if known:
        readings += [rewritten(text, known, draw), gathered(text, known, draw), (spoiled(text, known, draw), set())]
    mails = text.count("@")
    for said, good in readings:
        zones = zones_of(said)
        for span in candidates(said, zones):
            yield int(span in good), *words_beside(said, span[0], span[2]), features_of(said, span, mails, len(zones))


def train(docs: DataFrame, text: str = "text", id_column: str = "doc_id", precision: float = 0.95, bounds: Bounds = Bounds(), settings: boosting.Settings = boosting.Settings()) -> Model:
    """Fit on the candidates of the documents whose id hashes lowest, at most `bounds.documents` rows and `bounds.candidates`
    candidates (those of the lowest hash). Texts without a digit or @ have none and are not drawn. Without candidates of both
    labels the model accepts nothing, and only base spans are found. Null ids hash alike.
    """
    draw = F.xxhash64(F.lit("personal data sample"), F.col(f"`{id_column}`"))
    source = docs.select(draw.alias("id_hash"), F.col(f"`{text}`").cast("string").alias("text"))
    total = max(1, docs.count())
    # about half as many again as wanted, by the hash alone, before anything is put in order
    share = min(1.0, 1.5 * bounds.documents / total)
    low = source.filter((F.col("id_hash") / float(2**64)) < share - 0.5).filter(F.col("text").rlike("[@0-9]"))
    chosen = low.orderBy("id_hash", F.xxhash64("text")).limit(bounds.documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, texts in textkit.parts(batch.column(1)):
                for row, said in enumerate(texts.to_pylist()):
                    key = batch.column(0)[at + row].as_py()
                    found = list(_sample_rows(said, key))
                    if found:
                        label, before, after, features = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([key] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array(label, pa.int32()), pa.array(before), pa.array(after), pa.array([[float(x) for x in f] for f in features], pa.list_(pa.float64()))],
                            names=SAMPLE.names,
                        )

    rows = chosen.repartition(32, "id_hash").mapInArrow(run, SAMPLE).orderBy(F.xxhash64("id_hash", "number"), "id_hash", "number", "label", "before", "after").limit(bounds.candidates).toPandas()
    return fit_model(rows, precision, bounds, settings)


def fit_model(rows, precision: float, bounds: Bounds, settings: boosting.Settings) -> Model:
    """Trees on two thirds of the texts; calibration and thresholds on the other third."""
    y = rows["label"].to_numpy(int)
    if not len(y) or y.min() == y.max():
        return Model()
    x = np.array(rows["features"].tolist(), float)
    before, after = rows["before"].tolist(), rows["after"].tolist()
    held = rows["id_hash"].to_numpy(np.int64) % 3 == 1
    if not held.any() or held.all() or y[~held].min() == y[~held].max():
        held = np.zeros(len(y), bool)  # too few texts to hold some out
    of = lambda words, mask: [w for w, m in zip(words, mask, strict=True) if m]
    odds = [word_odds(of(words, ~held), y[~held], bounds.words) for words in (before, after)]
    full = _with_odds(x, before, after, *odds)
    trees = boosting.fit(full[~held], y[~held], settings)
    test = held if held.any() else ~held
    slope, offset = _logistic(trees.margin(full[test]), y[test])
    p = 1 / (1 + np.exp(-np.clip(slope * trees.margin(full[test]) + offset, -40, 40)))
    thresholds = tuple(threshold(p[x[test][:, 0] == k], y[test][x[test][:, 0] == k], precision) for k in range(len(KINDS)))
    return Model(trees, *odds, slope, offset, thresholds)


def threshold(p: np.ndarray, y: np.ndarray, precision: float, least: float = 0.5) -> float:
    """The least probability, `least` or more, from which on the candidates above it are precise enough; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    p, good = p[order], np.cumsum(y[order])
    last = np.append(p[1:] != p[:-1], True) if len(p) else np.zeros(0, bool)
    fits = np.flatnonzero(last & (good >= precision * np.arange(1, len(p) + 1)) & (p >= least))
    return float(p[fits[-1]]) if len(fits) else 2.0


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with labels drawn in a little."""
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -40, 40)))
        h = np.maximum(p * (1 - p), 1e-9)
        a, b, c = (h * margin * margin).sum() + 1e-3, (h * margin).sum(), h.sum() + 1e-3
        g1, g0 = ((target - p) * margin).sum() - 1e-3 * (slope - 1), (target - p).sum() - 1e-3 * offset
        det = a * c - b * b
        d1, d0 = (c * g1 - b * g0) / det, (a * g0 - b * g1) / det
        slope, offset = slope + float(np.clip(d1, -1, 1)), offset + float(np.clip(d0, -2, 2))
        if abs(d1) + abs(d0) < 1e-9:
            break
    return max(slope, 1e-3), offset


# ---- use ------------------------------------------------------------------------------------------------------------

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("probability", T.DoubleType())])
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("base", pa.bool_()), ("probability", pa.float64())])


def select(base: list[tuple[int, int, int]], accepted: list[tuple[float, tuple[int, int, int]]]) -> list[tuple[int, int, int, bool, float]]:
    """Base spans, and the accepted candidates that overlap none of them and no more probable one (then longer, then earlier).

    What is taken so far is kept as sorted, disjoint intervals."""
    starts, stops = [], []
    for start, _, stop in base:  # base spans of several kinds may overlap
        if starts and start < stops[-1]:
            stops[-1] = max(stops[-1], stop)
        else:
            starts.append(start)
            stops.append(stop)
    out = [(start, kind, stop, True, 1.0) for start, kind, stop in base]
    for p, (start, kind, stop) in sorted(accepted, key=lambda x: (-x[0], x[1][0] - x[1][2], x[1])):
        at = bisect_right(starts, start)
        if (at and stops[at - 1] > start) or (at < len(starts) and starts[at] < stop):
            continue
        starts.insert(at, start)
        stops.insert(at, stop)
        out.append((start, kind, stop, False, p))
    return sorted(out)


def find(texts: list[str], model: Model) -> list[list[tuple[int, int, int, bool, float]]]:
    """The spans of each text: (start, kind, end, base, probability), by start, then kind."""
    bases, proposed, rows, before, after = [], [], [], [], []
    for n, text in enumerate(texts):
        zones = zones_of(text)
        base = base_spans(text, zones)
        bases.append(base)
        if model.trees is None:
            continue
        taken, mails = set(base), text.count("@")
        for span in candidates(text, zones):
            if span not in taken:
                proposed.append((n, span))
                rows.append(features_of(text, span, mails, len(zones)))
                one, two = words_beside(text, span[0], span[2])
                before.append(one)
                after.append(two)
    accepted: list[list] = [[] for _ in texts]
    if rows:
        for (n, span), p in zip(proposed, model.probability(np.array(rows, float), before, after).tolist(), strict=True):
            if p >= model.thresholds[span[1]]:
                accepted[n].append((p, span))
    return [select(b, a) for b, a in zip(bases, accepted, strict=True)]


def redacted(text: str, spans: list[tuple[int, int, int, bool, float]]) -> str:
    """The text with [KIND] in place of every span; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, kind, stop, *_ in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, redact: bool = True) -> DataFrame:
    """Rows of `docs` with `spans` (start, stop, kind, base, probability; in code points, by start, then kind) and, if `redact`,
    the text without them.

    Null and empty texts have no span and an empty redacted text. Each row is judged alone. A result column replaces an input
    column of its name.
    """
    shared = docs.sparkSession.sparkContext.broadcast((None if model.trees is None else vars(model.trees), {**vars(model), "trees": None}))

    def compute(texts: pa.Array) -> list[pa.Array]:
        trees, rest = shared.value
        m = Model(**{**rest, "trees": None if trees is None else boosting.Trees(**trees)})
        said = texts.to_pylist()
        found = find(said, m)
        spans = pa.array([[{"start": a, "stop": b, "kind": KINDS[k], "base": x, "probability": p} for a, k, b, x, p in f] for f in found], pa.list_(_SPAN))
        return [spans, pa.array([redacted(t, f) for t, f in zip(said, found, strict=True)], pa.string())] if redact else [spans]

    fields = [T.StructField("spans", T.ArrayType(SPAN)), *([T.StructField("redacted", T.StringType())] if redact else [])]
    return textkit.with_text_columns(docs, text, fields, compute, keep)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))
