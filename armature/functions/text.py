"""String helpers whose whitespace rules follow Python, not SQL TRIM (which strips spaces only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: What Python calls whitespace, as a character class that Java and RE2 read alike.
SPACE = r"\t-\r\x1c- \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def strip_right(s: Column) -> Column:
    return F.regexp_replace(s, f"[{SPACE}]+\\z", "")


def strip(s: Column) -> Column:
    return F.regexp_replace(strip_right(s), f"\\A[{SPACE}]+", "")


def without_image_tag(s: Column) -> Column:
    return F.replace(s, F.lit("<image>"), F.lit(""))


def word_count(s: Column) -> Column:
    """Number of whitespace-separated words of the whole text, without building them as an array of copies."""
    return F.regexp_count(s, F.lit(f"[^{SPACE}]+")).cast("long")


def task_slug(s: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(s), r"[ \n.]", "_"), 1, 50)


def file_stem(s: Column) -> Column:
    """File name without folder and last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(F.regexp_replace(s, r"^.*/", ""), r"(?<=.)\.[^.]+$", "")


def from_code_points(points: Column) -> Column:
    """Code points -> text before the first NUL. The 8-digit hex form of each point is its UTF-32 encoding."""
    hexed = F.array_join(F.transform(points, lambda c: F.lpad(F.hex(c), 8, "0")), "")
    return F.split_part(F.decode(F.unhex(hexed), "UTF-32"), F.lit("\0"), F.lit(1))
