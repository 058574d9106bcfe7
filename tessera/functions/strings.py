"""Text column functions (STR*).  All return Columns built from Spark's own
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode word token: letters, digits and underscore in any script.
# (Java's \w is ASCII-only, so the class is spelled out.)
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def before_first(c, delim: str = ",") -> Column:
    """Text before the first delimiter; null when there is none (STR1)."""
    c = _c(c)
    pos = F.instr(c, delim)
    return F.when(pos > 0, F.substring(c, F.lit(1), pos - 1))


def after_first(c, delim: str = ",") -> Column:
    """Text after the first delimiter, leading blank kept (STR2)."""
    c = _c(c)
    pos = F.instr(c, delim)
    return F.when(pos > 0, F.substring(c, pos + len(delim), F.length(c)))


def replace(c, old: str, new: str = "") -> Column:
    """Replace literal text (STR3)."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def part_from_right(c, n: int, max_parts: int = 4) -> Column:
    """n-th part from the right of a '.'/','-delimited string, as the server's
    four-part name splitter does: more than ``max_parts`` parts gives null,
    empty parts are null, blanks are kept (STR4)."""
    parts = F.split(_c(c), r"[.,]")
    return F.when(
        (F.size(parts) <= max_parts) & (F.size(parts) >= n),
        F.nullif(F.element_at(parts, -n), F.lit("")))


def recode(c, mapping: dict) -> Column:
    """CASE recode; values outside the mapping pass through (STR5)."""
    c = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(c)


RATING_PATTERN = r"(\d+\.\d+)"


def rating_value(c) -> Column:
    """First decimal number in a rating text; no match gives null (STR6)."""
    return F.nullif(F.regexp_extract(_c(c), RATING_PATTERN, 1), F.lit(""))


def first_contained(c, names) -> Column:
    """First listed name that occurs in the text, list order wins (STR7)."""
    c = _c(c)
    return F.coalesce(*[F.when(c.contains(n), F.lit(n)) for n in names])


def pad_min(c, width: int = 200) -> Column:
    """Pad on the right to at least ``width`` characters, never cut (STR8)."""
    c = _c(c)
    return F.when(F.length(c) < width, F.rpad(c, width, " ")).otherwise(c)


def strip_prefix(c, word: str = "Reviewed") -> Column:
    """Remove a prefix word followed by a blank, then trim (STR9)."""
    return F.trim(F.regexp_replace(_c(c), word + r"\s", ""))


def words(c) -> Column:
    """Unicode word tokens of a text, in order (STR11)."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_PATTERN), 0)


def lower_words(c) -> Column:
    """Tokens of the lower-cased text (STR10 + STR11)."""
    return words(F.lower(_c(c)))


def word_count(c) -> Column:
    """Number of word tokens (STR12)."""
    return F.size(words(c))


def title(c) -> Column:
    """Title-case a label (STR13)."""
    return F.initcap(_c(c))


def format_money(c, prefix: str = "RM ") -> Column:
    """Fixed two-decimal money text, e.g. ``RM 35.00`` (STR14)."""
    return F.concat(F.lit(prefix), _c(c).cast("decimal(12,2)").cast("string"))


def parse_money(c, prefix: str = "RM") -> Column:
    """Money text with or without a blank after the prefix -> decimal (STR15)."""
    return F.trim(F.replace(_c(c), F.lit(prefix), F.lit(""))).try_cast("decimal(12,2)")


def mask(c, ch: str = "*") -> Column:
    """Mask a secret with one character per letter (STR16)."""
    return F.repeat(F.lit(ch), F.length(_c(c)))


def center(text: str, width: int = 100) -> str:
    """Centre a fixed title; the odd blank goes to the right."""
    left = max(width - len(text), 0) // 2
    return (" " * left + text).ljust(width)
