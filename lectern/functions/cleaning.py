"""Cleaners: Column to Column, one for each modality and generation. Null becomes the empty string."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import ALNUM, BLANK, SPACE, collapse, lines, lstrip, strip

MODALITIES = ["text", "image", "table", "figure", "code"]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _join_kept(parts: Column) -> Column:
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def clean_doc_g2(c: Column) -> Column:
    """Whole documents: one blank between words, only word characters and plain punctuation are kept."""
    kept = F.regexp_replace(_text(c), rf"[^{ALNUM}_{SPACE}.,!?;:\-()\[\]{{}}]", "")
    return F.trim(collapse(kept))


def clean_std_g2(c: Column, curly_quotes: bool = False) -> Column:
    """Blanks collapsed, dashes made hyphens, control characters dropped.

    A literal `, "'").replace(` becomes an apostrophe, as in the engine this one stands in for; curly_quotes adds
    what that replacement was probably meant to do.
    """
    t = F.replace(F.trim(collapse(_text(c))), F.lit(", \"'\").replace("), F.lit("'"))
    if curly_quotes:
        t = F.translate(F.translate(t, "“”", '""'), "‘’", "''")
    return F.regexp_replace(F.translate(t, "–—", "--"), r"[\x00-\x08\x{0b}-\x{1f}]", "")


def clean_code_g2(c: Column) -> Column:
    """Line ends stripped, blank lines at the beginning and the end dropped."""
    t = F.regexp_replace(_text(c), f"[{BLANK}]+\n", "\n")
    t = F.regexp_replace(t, rf"[{BLANK}]+\z", "")
    return F.regexp_replace(t, r"^\n+|\n+\z", "")


def clean_table_g2(c: Column) -> Column:
    """Rows without blanks around pipes, without outer pipes and without empty rows."""

    def row(x: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(x, rf"[{SPACE}]*\|[{SPACE}]*", "|"), r"^\|+|\|+\z", "")
        return strip(bare)

    return _join_kept(F.transform(lines(_text(c)), row))


def clean_image_g2(c: Column) -> Column:
    return strip(F.regexp_replace(collapse(_text(c)), rf"(?i)^(Figure|Image|Photo|Picture)[{SPACE}]*\p{{Nd}}*[:{SPACE}]*", ""))


def clean_figure_g2(c: Column) -> Column:
    return strip(F.regexp_replace(collapse(_text(c)), rf"(?i)^(Figure|Fig)[{SPACE}]*\p{{Nd}}*[:{SPACE}]*", ""))


def clean_ocr_g1(c: Column) -> Column:
    """A lone 0 is read as O and a lone 1 as l; an I is put at every word boundary (a known defect, reproduced, never a default)."""
    t = F.regexp_replace(F.regexp_replace(_text(c), r"\b0\b", "O"), r"\b1\b", "l")
    return F.regexp_replace(t, r"\b", "I")


def clean_fmt_g1(c: Column) -> Column:
    """No blanks before closing marks, after opening ones and around double quotes."""
    t = F.regexp_replace(_text(c), rf"[{SPACE}]+([.,;:!?])", "$1")
    t = F.regexp_replace(t, rf"\([{SPACE}]+", "(")
    t = F.regexp_replace(t, rf"[{SPACE}]+\)", ")")
    t = F.regexp_replace(t, rf'"[{SPACE}]+', '"')
    return F.regexp_replace(t, rf'[{SPACE}]+"', '"')


def clean_std_g1(c: Column) -> Column:
    """Printable ASCII only, blanks collapsed, then the OCR and formatting rules."""
    t = F.regexp_replace(_text(c), r"[^\x20-\x7E\n\t]", "")
    return strip(clean_fmt_g1(clean_ocr_g1(collapse(t))))


def clean_code_g1(c: Column) -> Column:
    """Blank lines dropped, indentation re-emitted as blanks of the same width."""
    kept = lambda x: F.when(strip(x) != "", F.concat(F.repeat(F.lit(" "), F.length(x) - F.length(lstrip(x))), strip(x))).otherwise("")
    return _join_kept(F.transform(lines(_text(c)), kept))


def clean_table_g1(c: Column) -> Column:
    row = lambda x: strip(collapse(F.regexp_replace(x, rf"[{SPACE}]*\|[{SPACE}]*", " | ")))
    return _join_kept(F.transform(lines(_text(c)), row))


def clean_image_g1(c: Column) -> Column:
    return collapse(strip(_text(c)))


clean_figure_g1 = clean_image_g1

G2: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "text": ("standard", clean_std_g2),
    "code": ("code", clean_code_g2),
    "table": ("table", clean_table_g2),
    "image": ("image", clean_image_g2),
    "figure": ("figure", clean_figure_g2),
}
G1: dict[str, Callable[[Column], Column]] = {"text": clean_std_g1, "code": clean_code_g1, "table": clean_table_g1, "image": clean_image_g1, "figure": clean_figure_g1}


def _by_modality(modality: Column, values: dict[str, Column], other: Column) -> Column:
    out = None
    for name, value in values.items():
        out = F.when(modality == name, value) if out is None else out.when(modality == name, value)
    return out.otherwise(other)


def clean_dispatch_g2(chunks: DataFrame, content: str = "content", modality: str = "modality") -> DataFrame:
    """Content cleaned by its modality's rules, with original_length, cleaned_length and cleaning_strategy; other modalities get the standard rules."""
    c, m = F.col(content), F.col(modality)
    cleaned = _by_modality(m, {k: f(c) for k, (_, f) in G2.items() if k != "text"}, clean_std_g2(c))
    strategy = _by_modality(m, {k: F.lit(s) for k, (s, _) in G2.items() if k != "text"}, F.lit("standard"))
    out = chunks.withColumn("original_length", F.length(_text(c))).withColumn(content, cleaned)
    return out.withColumns({"cleaned_length": F.length(content), "cleaning_strategy": strategy, "cleaned": F.lit(True)})


def clean_dispatch_g1(chunks: DataFrame, content: str = "content", modality: str = "modality") -> DataFrame:
    """Content cleaned by its modality's rules; unknown modalities keep theirs; the embedding, made from other text, is dropped."""
    c = F.col(content)
    return chunks.withColumn(content, _by_modality(F.col(modality), {k: f(c) for k, f in G1.items()}, c)).drop("embedding")
