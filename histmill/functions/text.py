"""Scalar text functions (SC1-SC17), all native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What `\s` matches. A single content line surrounded by it becomes the content
# (SC4, `s/^\s*(.*?)\s*$/$1/`); `.` stops at line feeds only, so a text with two
# or more content lines is left alone.
SPACE = " \t\n\u000b\f\r"
# First sentence (SC5): skip leading space, then at least three characters, up
# to a '.' that is not followed by a digit, or a newline. The possessive `*+`
# keeps the JVM regex engine from recursing once per character. The original
# replaces the whole text by its first sentence (`^...(sentence).*$` -> sentence).
# Its trailing `.*$` matches whatever follows, so the result is exactly the
# sentence whenever the sentence pattern matches at the start, and the
# unchanged whole text otherwise; the expressions below compute that result
# without the redundant `.*$` step. No text is truncated.
FIRST_SENTENCE = r"(?s)^\s*(\S.{2}(?:[^.\n]|\.\d)*+)"
# SC6: same without skipping leading space; a match must reach three characters.
FIRST_SENTENCE_RAW = r"(?s)^(.{3}(?:[^.\n]|\.\d)*+)"


def truthy(c: Column) -> Column:
    """FLT9: NULL, empty and '0' are false."""
    return c.isNotNull() & ~c.cast("string").isin("", "0")


def has_non_space(c: Column) -> Column:
    """`m/\\S/` on a possibly NULL value."""
    return F.coalesce(c.rlike(r"\S"), F.lit(False))


def crlf_to_lf(c: Column) -> Column:
    """SC2."""
    return F.replace(c, F.lit("\r\n"), F.lit("\n"))


def trim_single_line(c: Column) -> Column:
    """SC4, without a regex: its lazy quantifier tries the rest of the pattern at every character."""
    content = F.btrim(c, F.lit(SPACE))
    return F.when(F.instr(content, "\n") == 0, content).otherwise(c)


def first_sentence(c: Column) -> Column:
    """SC5: unchanged when the pattern does not match."""
    return F.when(c.rlike(FIRST_SENTENCE), F.regexp_extract(c, FIRST_SENTENCE, 1)).otherwise(c)


def first_sentence_raw(c: Column) -> Column:
    """SC6."""
    return F.when(c.rlike(FIRST_SENTENCE_RAW), F.regexp_extract(c, FIRST_SENTENCE_RAW, 1)).otherwise(c)


def xml_escape(c: Column) -> Column:
    """SC7: `&` first, then `<` and `>`."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def ci(c: Column) -> Column:
    """Compare key under the source server's collation: case and trailing spaces do not count."""
    return F.lower(F.rtrim(c))


def sql_len(c: Column) -> Column:
    """SC8: T-SQL LEN ignores trailing spaces."""
    return F.length(F.rtrim(c))


def flip_name(c: Column) -> Column:
    """SC9: 'Last, First' -> 'First Last' when the comma is after position 1."""
    pos = F.locate(",", c)
    first = F.ltrim(F.substr(c, pos + 1))
    last = F.substr(c, F.lit(1), pos - 1)
    return F.when(pos > 1, F.concat(first, F.lit(" "), last)).otherwise(c)


LOGIN_PATTERN = r"^([^\\]*)\\(\S*)\s*$"


def login_domain(c: Column) -> Column:
    """SC10: domain part of `DOMAIN\\user` (NULL when unparsable)."""
    return F.when(c.rlike(LOGIN_PATTERN), F.regexp_extract(c, LOGIN_PATTERN, 1))


def login_name(c: Column) -> Column:
    return F.when(c.rlike(LOGIN_PATTERN), F.regexp_extract(c, LOGIN_PATTERN, 2))


def whitespace_to_underscore(c: Column) -> Column:
    return F.regexp_replace(c, r"\s", "_")


def replace_chain(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """SC1: apply literal replacements in order (each sees the previous result)."""
    out = c
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def replace_chain_ci(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """SC1 under a case-insensitive collation: matches ignore case, as on the source server."""
    out = c
    for old, new in pairs:
        out = F.regexp_replace(out, "(?i)" + _quote(old), _quote_repl(new))
    return out


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+?^$|" else ch for ch in s)


def _quote_repl(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")
