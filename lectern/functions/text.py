"""Text primitives whose meaning doesn't hang on a regex engine's idea of white space, digits or word characters."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space in the sense of Unicode strings, written so that java.util.regex and RE2 read it alike.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters themselves.
WHITE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
#: The class without the line feed.
BLANK = SPACE.replace(r"\t-\r", r"\t\x{0b}-\r")
#: Letters and numbers, what isalnum() accepts.
ALNUM = r"\p{L}\p{N}"


def _digits() -> str:
    """Character class of what counts as a digit: decimal digits, and digits such as superscripts, made from the character database."""
    rest = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"]
    parts, at = [], 0
    while at < len(rest):
        end = at
        while end + 1 < len(rest) and rest[end + 1] == rest[end] + 1:
            end += 1
        parts.append(f"\\x{{{rest[at]:x}}}-\\x{{{rest[end]:x}}}")
        at = end + 1
    return r"\p{Nd}" + "".join(parts)


DIGIT = _digits()


def collapse(c: Column) -> Column:
    """Runs of white space become one blank; blanks that stand alone aren't touched, which are most."""
    other = SPACE.replace(r"\x{1c}-\x{20}", r"\x{1c}-\x{1f}")
    return F.regexp_replace(c, f" [{SPACE}]+|[{other}][{SPACE}]*", " ")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITE))


def words(c: Column) -> Column:
    """Pieces between white space, without empty ones."""
    return F.filter(F.split(c, f"[{SPACE}]+", -1), lambda w: w != "")


def lines(c: Column) -> Column:
    """Pieces between line feeds, trailing empty ones kept."""
    return F.split(c, "\n", -1)


def not_blank(c: Column) -> Column:
    return c.rlike(f"[^{SPACE}]")


def is_upper(c: Column) -> Column:
    """At least one cased character and no lower-case one."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def count_of(c: Column, what: str) -> Column:
    """Occurrences of a literal."""
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for each row, however often later expressions name them.

    The optimizer puts a column's expression in place of its name; inside lambdas that would compute it once for each
    element. A generator of one row stops it.
    """
    made = F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))
    return df.select("*", made.alias("_pinned")).select(*df.columns, *[F.col(f"_pinned.{k}").alias(k) for k in columns])
