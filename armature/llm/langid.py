"""Language identification by cross-parsing.

For every language a suffix automaton of a labelled text of bounded length is built. A text is parsed greedily against each
automaton: a phrase is the longest run that occurs somewhere in the language's text. A phrase costs about log2 of the length
of that text, so the cost of a text is phrases x log2(length), and the language with the least cost wins. A symbol that the
language's text lacks is a phrase that matches nothing; it costs as much as the dearest phrase of any language, and log2 of
the alphabet at least, so that no language wins by lack of text.

Texts are lower-cased and reduced to the letters and digits that the training texts have, with single gaps between them; a
text in a script of no language keeps nothing and speaks for none.
Every letter of the training texts is a symbol of its own. The automata are flat transition tables in which a missing
transition already leads to where the next phrase begins, with a flag; a batch of texts is parsed in lanes of at most `LANE`
symbols, one table lookup per symbol, lane and language. The tables have columns for the `COLUMNS` most frequent symbols; the
transitions of rarer ones (Han, Hangul, many alphabets side by side) are kept sorted and found by binary search. Whole
texts are parsed: a long text is many lanes, which adds at most a phrase per lane, for every language alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import textkit

LANE = 256
COLUMNS = 256
FLAG = 1 << 30
UNKNOWN = "und"


@dataclass(frozen=True)
class Bounds:
    """The bounded labelled sample: distinct texts of a language, characters of a piece of each, and symbols of a language and
    in all that are learned, in equal shares of the texts. Everything else covers all rows."""

    rows_per_language: int = 64
    row_chars: int = 20_000
    symbols_per_language: int = 16_384
    symbols_in_all: int = 400_000
    languages: int = 400


@dataclass(frozen=True)
class Model:
    languages: list[str]
    symbols: np.ndarray  # code point -> symbol; 0 is a gap
    width: int  # columns of the table; symbols from here on are rare
    table: np.ndarray
    roots: np.ndarray
    bits: np.ndarray
    begins: np.ndarray  # language, symbol -> where a phrase that begins with it leads; the language's root if it lacks it
    keys: np.ndarray  # sorted: row of the table x symbols + symbol, for rare symbols
    targets: np.ndarray
    miss_bits: float


def code_points(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each text starts among them."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    found = data[at].astype(np.uint32)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=before[1:])
    wide = np.flatnonzero(found >= 0x80)
    if len(wide):
        spot, first = at[wide], found[wide]
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        tail = [padded[spot + k].astype(np.uint32) & 63 for k in (1, 2, 3)]
        found[wide] = np.where(
            first < 0xE0,
            (first & 31) << 6 | tail[0],
            np.where(first < 0xF0, (first & 15) << 12 | tail[0] << 6 | tail[1], (first & 7) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]),
        )
    return found, before[starts]


def to_symbols(texts: pa.Array, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts without repeated or leading gaps, and where each text starts."""
    points, starts = code_points(*textkit.raw_bytes(pc.utf8_lower(texts)))
    if not len(points):
        return np.zeros(0, symbols.dtype), np.zeros(len(texts) + 1, np.int64)
    found = symbols[points]
    before = np.zeros(len(found), found.dtype)
    before[1:] = found[:-1]
    edge = starts[:-1][starts[:-1] < len(found)]
    before[edge] = 0
    keep = (found != 0) | (before != 0)
    count = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=count[1:])
    return found[keep], count[starts]


def letter_symbols(texts: list[pa.Array]) -> tuple[np.ndarray, int]:
    """Code point -> symbol for all letters and digits of the training texts, the most frequent first if they are more than
    the columns; all else, scripts of no language as well, is a gap."""
    seen = np.zeros(0x110000, np.int64)
    for t in texts:
        seen += np.bincount(code_points(*textkit.raw_bytes(pc.utf8_lower(t)))[0], minlength=0x110000)
    used = [c for c in np.flatnonzero(seen).tolist() if chr(c).isalnum()]
    used.sort(key=lambda c: -seen[c])
    used = sorted(used[: COLUMNS - 1]) + sorted(used[COLUMNS - 1 :])
    table = np.zeros(0x110000, np.uint8 if len(used) < 256 else np.int32)
    table[used] = np.arange(1, len(used) + 1)
    return table, len(used) + 1


def automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of `text`; state 0 is the empty word."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text.tolist():
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves


def shares(sizes: np.ndarray, budget: int) -> np.ndarray:
    """Equal shares of `budget`; what short texts leave goes to the longer ones."""
    out, left = np.zeros(len(sizes), np.int64), budget
    for done, i in enumerate(np.argsort(sizes, kind="stable")):
        out[i] = min(sizes[i], left // (len(sizes) - done))
        left -= out[i]
    return out


def sampled(parts: np.ndarray, starts: np.ndarray, budget: int) -> np.ndarray:
    """Up to `budget` symbols, an equal share from the start of every text, with a gap between texts."""
    sizes = np.diff(starts)
    share = shares(sizes, max(0, budget - max(0, len(sizes) - 1)))
    pieces = [x for at, n in zip(starts, share) for x in (np.zeros(1, parts.dtype), parts[at : at + n])]
    out = np.concatenate(pieces) if pieces else parts
    return out[(out != 0) | (np.concatenate([[0], out[:-1]]) != 0)]


def build(languages: list[str], texts: list[pa.Array], bounds: Bounds) -> Model:
    """Tables of all languages one after the other. A language's first row is where a phrase has not begun yet."""
    symbols, letters = letter_symbols(texts)
    width = min(letters, COLUMNS)
    budget = min(bounds.symbols_per_language, bounds.symbols_in_all // max(1, len(languages)))
    tables, roots, bits, base = [], [], [], 0
    begins, keys, targets = np.zeros((len(texts), letters), np.int32), [], []
    for nth, t in enumerate(texts):
        parts, starts = to_symbols(t, symbols)
        text = sampled(parts, starts, budget)
        moves = automaton(text)
        begins[nth] = base
        for symbol, target in moves[0].items():
            begins[nth, symbol] = base + (target + 1) * width
        table = np.tile(FLAG | begins[nth, :width], (len(moves) + 1, 1))
        for state, out in enumerate(moves):
            for symbol, target in out.items():
                if symbol < width:
                    table[state + 1, symbol] = base + (target + 1) * width
                else:
                    keys.append((base // width + state + 1) * letters + symbol)
                    targets.append(base + (target + 1) * width)
        tables.append(table.reshape(-1))
        roots.append(base)
        bits.append(np.log2(max(2, len(text))))
        base += table.size
    table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
    order = np.argsort(np.array(keys, np.int64))
    sparse = np.array(keys, np.int64)[order], np.array(targets, np.int32)[order]
    return Model(languages, symbols, width, table, np.array(roots, np.int32), np.array(bits), begins, *sparse, max([np.log2(letters), *bits]))


def rare_steps(model: Model, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """What the table would hold for states (language, lane) and the rare symbols of the lanes."""
    step = FLAG | model.begins[:, symbols]
    lang, lane = np.nonzero(step != FLAG | model.roots[:, None])  # only languages that have the symbol
    wanted = (state[lang, lane] // model.width).astype(np.int64) * model.begins.shape[1] + symbols[lane]
    at = np.minimum(np.searchsorted(model.keys, wanted), len(model.keys) - 1)
    found = model.keys[at] == wanted
    step[lang[found], lane[found]] = model.targets[at[found]]
    return step


def misses(model: Model, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbols of each text (columns) that each language (rows) lacks."""
    out = np.zeros((len(model.languages), len(starts) - 1), np.int64)
    for row, lacks in zip(out, model.begins == model.roots[:, None], strict=True):
        spot = np.flatnonzero(lacks[symbols]) if lacks.any() else []
        if len(spot):
            row += np.diff(np.searchsorted(spot, starts))
    return out


def phrases(model: Model, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Phrases of each text (columns) against each language (rows)."""
    texts, n_lang = len(starts) - 1, len(model.languages)
    size = np.diff(starts)
    lanes = -(-size // LANE)
    owner = np.repeat(np.arange(texts), lanes)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = starts[:-1][owner] + nth * LANE
    long = np.minimum(LANE, size[owner] - nth * LANE)
    order = np.argsort(-long, kind="stable")
    owner, at, long = owner[order], at[order], long[order]
    alive = np.searchsorted(-long, -np.arange(LANE), side="left")  # lanes longer than t
    count = np.zeros((n_lang, len(owner)), np.int32)
    # a block of lanes at a time, so that states stay in the cache
    for low in range(0, len(owner), 4096):
        high = min(low + 4096, len(owner))
        state = np.repeat(model.roots[:, None], high - low, axis=1)
        for t in range(LANE):
            end = min(int(alive[t]), high) - low
            if end <= 0:
                break
            now = symbols[at[low : low + end] + t]
            rare = np.flatnonzero(now >= model.width) if len(model.keys) else ()
            if len(rare):
                step = model.table[state[:, :end] + np.where(now < model.width, now, 0)]
                step[:, rare] = rare_steps(model, state[:, rare], now[rare])
            else:
                step = model.table[state[:, :end] + now]
            count[:, low : low + end] += step >> 30
            state[:, :end] = step & (FLAG - 1)
    return np.stack([np.bincount(owner, weights=c, minlength=texts) for c in count]) if n_lang else np.zeros((0, texts))


def train(docs: DataFrame, text: str, lang: str, id_column: str | None = None, bounds: Bounds = Bounds()) -> Model:
    """Model from rows with a language and a text. The sample of a language is its distinct texts whose hash is least, so
    copies and repeated ids count once and `id_column` is not read; of a text longer than `row_chars` it has a piece of that
    length from a place that the hash draws."""
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "text"), F.lit(1 << 40))
    named = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).dropna().withColumn("draw", drawn)
    counts = named.groupBy("lang").agg(F.approx_count_distinct("draw").alias("texts"))
    few = counts.limit(bounds.languages + 1).collect()
    if len(few) > bounds.languages:
        raise ValueError(f"more than {bounds.languages} languages")
    if not few:
        return build([], [], bounds)
    # The least draws of a language are among those below a bar that four times as many distinct texts are expected to pass,
    # so only a few rows per language are put in order.
    spark = docs.sparkSession
    bars = spark.createDataFrame([(r.lang, min(1.0, 4.0 * bounds.rows_per_language / max(1, r.texts))) for r in few], "lang string, bar double")
    below = named.join(F.broadcast(bars), "lang").filter(F.col("draw") < F.col("bar") * float(1 << 40)).select("lang", "draw").distinct()
    first = below.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).filter(F.col("place") <= bounds.rows_per_language)
    chosen = first.collect()
    if not chosen:
        return build([], [], bounds)
    picked = spark.createDataFrame([(r.lang, r.draw) for r in chosen], "lang string, draw long")
    # the place is drawn among all places at which a whole piece fits
    place = F.pmod(F.xxhash64(F.lit("piece"), "draw"), F.greatest(F.lit(1), F.length("text") - bounds.row_chars + 1)).cast("int") + 1
    piece = F.col("text").substr(place, F.lit(bounds.row_chars)).alias("piece")
    sample = named.join(F.broadcast(picked), ["lang", "draw"], "left_semi").select("lang", "draw", piece).distinct().collect()
    languages = sorted({r.lang for r in sample})
    ordered = sorted(sample, key=lambda r: (r.lang, r.draw, r.piece))
    return build(languages, [pa.array([r.piece for r in ordered if r.lang == x], pa.large_string()) for x in languages], bounds)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Rows of `docs` with the language and a score from 0 to 1: the share of the winner if costs are read as code lengths.

    A null text, a text without a letter, or a model without languages gives `und` with score 0. A text whose letters no
    language has is given the first language by name, with score 0; so are equal costs, with their equal share. A result column replaces an input column of its name; other columns are carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers may lack this package
    labels = [*model.languages, UNKNOWN]

    def compute(texts: pa.Array) -> list[pa.Array | np.ndarray]:
        m = Model(**shared.value)
        has_letter = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        best, score = np.full(len(texts), len(m.languages)), np.zeros(len(texts))
        if m.languages:
            symbols, starts = to_symbols(texts, m.symbols)
            lacking = misses(m, symbols, starts)
            cost = (phrases(m, symbols, starts) - lacking) * m.bits[:, None] + lacking * m.miss_bits
            winner = cost.argmin(axis=0)
            share = 1 / np.exp2(np.maximum(-1000, cost.min(axis=0) - cost)).sum(axis=0)
            best = np.where(has_letter, winner, best)
            score = np.where(has_letter & (np.diff(starts) > 0), share, score)
        return [pa.array(labels).take(pa.array(best)), score]

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return textkit.with_text_columns(docs, text, fields, compute, keep)
