"""Quality rules, line first: lines that break a rule are removed, then documents that lose too much text.

Words, windows and lines of a batch are found and compared with numpy; equal means equal 64-bit hash and equal length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import textkit
from armature.llm.quality import _not_newline

#: Characters that end a sentence or announce what follows, in all scripts that have them: Latin and common ones,
#: Armenian, Hebrew and Arabic, Indic, South-East Asian, Tibetan, Ethiopic, Canadian, Mongolian and others, and East Asian.
TERMINAL = ".!?…:;‼‽⁇⁈⁉⸮" + "։՜՞" + "׃؛؟۔܀܁܂߹" + "।॥෴" + "၊။។៕៖៚᪨᪩᪪᪫᭚᭛᭞᭟꧈꧉꩝꩞꩟꤯" + "།༎༏༐" + "።፧፨፥፦" + "᙮" + "᠃᠉᥄᥅" + "᰻᰼᱾᱿꓿꘎꘏꛳꛷꡶꡷꣎꣏꫰꫱꯫"
#: The East Asian ones need no space behind them.
WIDE = "。！？：；．｡﹒﹖﹗"
CLOSING = "\"'”’»)\\]*」』）"
#: Separators of menus and tables.
SEPARATORS = "|»›•·→"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Rules of a line, then of a document.

    A line breaks the punctuation rule if less than `ended_share` of it, in characters, stands in sentences that end in it. A line
    of `short_words` or more (four characters of an unspaced script count as one) may do so where it is a wrapped part of a
    paragraph (the next line goes on in lower case, or it has fewer than `wrap_words` words and the last line before an empty
    one or the end of the text ends with a mark), where its paragraph is verse (`verse_lines` or more lines, none twice as long in words as another, most words not
    capitalized), and where it is in a script other than Latin, Greek or Cyrillic, in which the document shows no mark at all.
    A line breaks the navigation rule if separators stand between at least `bar_share` of its words; the symbol rule if at least `symbol_share` of its characters are symbols; the capitals
    rule if at least `capital_share` of its (five or more) words are in capitals and end in a mark; and the boilerplate
    rule if it is no longer than `boilerplate_words` and matches `boilerplate`.
    """

    ended_share: float = 0.5
    wrap_words: int = 60
    short_words: int = 3
    verse_lines: int = 4
    bar_share: float = 0.3
    symbol_share: float = 0.1
    capital_share: float = 0.7
    boilerplate_words: int = 30
    boilerplate: str = (
        r"(?i)\b(?:cookies? (?:policy|settings|preferences)|we use cookies|accept (?:all )?cookies|enable javascript|all rights reserved|"
        r"terms (?:of|and) (?:use|service|conditions)|privacy policy|subscribe to our|sign up for our|click here|share this|"
        r"read more|log ?in|back to top|skip to (?:main )?content|page not found)\b"
    )
    least_words: int = 10
    most_repeated_percent: int = 20
    most_lost: float = 0.5


FIELDS = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    *[T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed_lines")],
    T.StructField("lost_share", T.DoubleType()),
    T.StructField("clean_text", T.StringType()),
]


def _per_text(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, n).astype(np.int64)


def repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether its text has an equal one at all, and whether it has an equal one before it."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    o, h = owner[order], hashes[order]
    same = (o[1:] == o[:-1]) & (h[1:] == h[:-1])
    later = np.zeros(len(order), bool)
    later[1:] = same
    any_ = later.copy()
    any_[:-1] |= same
    out_any, out_later = np.empty_like(any_), np.empty_like(later)
    out_any[order], out_later[order] = any_, later
    return out_any, out_later


def measure(texts: pa.Array, rules: Rules, window: int = 5) -> list[pa.Array | np.ndarray]:
    n = len(texts)
    data, starts = textkit.raw_bytes(texts)
    words = textkit.Words(data, starts, textkit.not_space())
    owner, count = words.text_index(), np.diff(words.first)
    first_byte = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(first_byte)])
    word_chars = _per_text(owner, n, (chars[words.end] - chars[words.start]).astype(float))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    is_symbol = symbol[data]
    symbols_before = np.concatenate([[0], np.cumsum(is_symbol)])
    n_symbols = symbols_before[starts[1:]] - symbols_before[starts[:-1]]

    # windows of five words that are found twice or more in their text
    in_repeat = np.zeros(len(words), bool)
    if len(words) >= window:
        key = words.hash[: len(words) - window + 1].copy()
        for k in range(1, window):
            key = textkit.mix(key + np.uint64(k)) ^ words.hash[k : len(words) - window + 1 + k]
        at = np.flatnonzero(owner[: len(key)] == owner[window - 1 :])
        twice, _ = repeated(owner[at], key[at])
        for k in range(window):
            in_repeat[at[twice] + k] = True
    n_repeat = _per_text(owner[in_repeat], n)

    # lines: maximal runs without a newline; empty lines have no word and are no part of any count
    lines = textkit.Words(data, starts, _not_newline())
    line_owner = lines.text_index()
    word_line = np.searchsorted(lines.start, words.start, side="right") - 1
    line_words = np.bincount(word_line, minlength=len(lines))
    full = np.flatnonzero(line_words > 0)
    _, again = repeated(line_owner[full], textkit.mix(lines.hash[full]) + (lines.end - lines.start)[full].astype(np.uint64))
    n_dup = _per_text(line_owner[full][again], n)

    bad = _bad_lines(data, words, word_line, lines, line_words, chars, symbols_before, rules)
    line_chars = chars[lines.end] - chars[lines.start]
    total, lost = _per_text(line_owner, n, line_chars.astype(float)), _per_text(line_owner[bad], n, line_chars[bad].astype(float))
    share = lost / np.maximum(1, total)
    base_failed = (count < rules.least_words) | (100 * n_repeat > rules.most_repeated_percent * count)
    kept = ~base_failed & (share <= rules.most_lost)
    return [
        count.astype(np.int64), word_chars, n_symbols.astype(np.int64), n_dup, n_repeat, base_failed, kept,
        _per_text(line_owner[line_words > 0], n), _per_text(line_owner[bad], n), share, _without(data, starts, lines, bad),
    ]


def _bad_lines(data, words, word_line, lines, line_words, chars, symbols_before, rules: Rules) -> np.ndarray:
    """Which lines break a rule. Lines without a word break none."""
    count = len(lines)
    if not count:
        return np.zeros(0, bool)
    texts = _strings(data, lines.start, lines.end)
    end = f"(?:[{TERMINAL}{WIDE}][{CLOSING}]*)"
    ends = pc.match_substring_regex(texts, rf"{end}\s*$").to_numpy(zero_copy_only=False)
    tail = pc.replace_substring_regex(texts, rf"(?s)^.*(?:{end}(?:\s+|$)|[{WIDE}][{CLOSING}]*)", "")
    unended = pc.utf8_length(tail).to_numpy(zero_copy_only=False)
    bars = pc.count_substring_regex(texts, f"[{SEPARATORS}]").to_numpy()
    boilerplate = pc.match_substring_regex(texts, rules.boilerplate).to_numpy(zero_copy_only=False)
    line_chars = np.maximum(1, chars[lines.end] - chars[lines.start])
    symbols = symbols_before[lines.end] - symbols_before[lines.start]

    last = data[words.end - 1]
    upper = np.concatenate([[0], np.cumsum((data >= 0x41) & (data <= 0x5A))])
    lower = np.concatenate([[0], np.cumsum((data >= 0x61) & (data <= 0x7A))])
    shouted = (upper[words.end] > upper[words.start]) & (lower[words.end] == lower[words.start]) & ((last == 0x21) | (last == 0x3F))
    capitals = np.bincount(word_line[shouted], minlength=count)

    some = np.maximum(1, line_words)
    full = line_words > 0
    goes_on, closed = _wrapped(lines, line_words, ends, pc.match_substring_regex(texts, r"^[\s\"'“”‘’«»(\[]*\p{Ll}").to_numpy(zero_copy_only=False))
    # characters of scripts beyond Latin, Greek and Cyrillic, by the first byte; general punctuation is no script
    lead = ((data >= 0xD5) & (data <= 0xDF)) | ((data >= 0xE0) & (data <= 0xF4) & (data != 0xE2) & (data != 0xEF))
    leads = np.concatenate([[0], np.cumsum(lead)])
    foreign = leads[lines.end] - leads[lines.start]
    other = full & (2 * foreign > line_chars)
    some_end = ends | (unended < line_chars)
    owner = lines.text_index()
    marked = np.zeros(int(owner.max()) + 1, bool)
    marked[owner[other & some_end]] = True
    small = line_words + foreign // 4 < rules.short_words
    first = data[words.start]
    capital = np.bincount(word_line[(first >= 0x41) & (first <= 0x5A)], minlength=count)
    wrapped = goes_on | (closed & (line_words < rules.wrap_words))
    excused = wrapped | _verse(lines, line_words, capital, rules) | (other & ~marked[owner])
    punctuation = (unended > (1 - rules.ended_share) * line_chars) & (small | ~excused)
    navigation = (bars >= 2) & (bars >= rules.bar_share * some)
    noisy = symbols >= rules.symbol_share * line_chars
    shouting = (line_words >= 5) & (capitals >= rules.capital_share * some)
    return (line_words > 0) & (punctuation | navigation | noisy | shouting | (boilerplate & (line_words <= rules.boilerplate_words)))


def _wrapped(lines, line_words: np.ndarray, ends: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which lines the next line of their paragraph goes on in lower case, and whose paragraph ends with a mark."""
    goes_on, closed = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    full = np.flatnonzero(line_words > 0)
    if not len(full):
        return goes_on, closed
    owner = lines.text_index()[full]
    follows = np.zeros(len(full), bool)  # the next line is in the same paragraph: one newline is between
    follows[:-1] = (owner[1:] == owner[:-1]) & (lines.start[full[1:]] - lines.end[full[:-1]] == 1)
    last = np.flatnonzero(~follows)
    goes_on[full[:-1]] = follows[:-1] & lower[full[1:]]
    closed[full] = ends[full[last[np.searchsorted(last, np.arange(len(full)))]]]
    return goes_on, closed


def _verse(lines, line_words: np.ndarray, capital: np.ndarray, rules: Rules) -> np.ndarray:
    """Which lines stand in a paragraph of enough lines of like length whose words are mostly not capitalized."""
    out = np.zeros(len(lines), bool)
    full = np.flatnonzero(line_words > 0)
    if not len(full):
        return out
    owner = lines.text_index()[full]
    begins = np.ones(len(full), bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (lines.start[full[1:]] - lines.end[full[:-1]] != 1)
    at = np.flatnonzero(begins)
    size = np.diff(np.append(at, len(full)))
    least, most = np.minimum.reduceat(line_words[full], at), np.maximum.reduceat(line_words[full], at)
    total, capitals = np.add.reduceat(line_words[full], at), np.add.reduceat(capital[full], at)
    alike = (size >= rules.verse_lines) & (least >= rules.short_words) & (most < 2 * least) & (2 * capitals < total)
    out[full] = np.repeat(alike, size)
    return out


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Text ranges that follow each other, as one string array over the same bytes."""
    joined = np.empty(2 * len(start) + 1, np.int64)
    joined[0:-1:2], joined[1::2], joined[-1] = start, end, end[-1]
    both = pa.LargeStringArray.from_buffers(len(joined) - 1, pa.py_buffer(joined), pa.py_buffer(np.ascontiguousarray(data)))
    return both.take(pa.array(np.arange(0, len(joined) - 1, 2)))


def _without(data: np.ndarray, starts: np.ndarray, lines, bad: np.ndarray) -> pa.Array:
    """The texts without the bad lines and the newline after each."""
    drop = np.zeros(len(data) + 2, np.int32)
    drop[lines.start[bad]] += 1
    stop = lines.end[bad]
    limit = starts[lines.text_index()[bad] + 1]
    drop[np.minimum(stop + 1, limit)] -= 1
    keep = np.cumsum(drop[: len(data)]) == 0
    before = np.concatenate([[0], np.cumsum(keep)])
    return pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(before[starts].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[keep]))).cast(pa.string())


def apply_rules(docs: DataFrame, text: str = "text", rules: Rules = Rules(), keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with `FIELDS`: counts over the whole text, `base_failed`, `kept`, what was removed and `clean_text`.

    A null or empty text has no words: it fails the base rules and its clean text is empty. Each row is judged alone, so
    repeated rows get equal verdicts. A result column replaces an input column of its name; other columns are carried.
    """
    return textkit.with_text_columns(docs, text, FIELDS, lambda texts: measure(texts, rules), keep)
