"""What a line or an image is, told by its looks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import SPACE, count_of, strip

# The rules that make a stripped line code.
CODE_LINE = [
    rf"^(def|class|import|from|if|for|while|try|except|with)[{SPACE}]",
    rf"^[a-zA-Z_][a-zA-Z0-9_]*[{SPACE}]*[=:]",
    r"^[{}()\[\]]\z",
    r"^#[^\n]*\z",
]
# The rules that make a line of a page look like code, in the order in which they are tried.
CODE_LIKE = [
    rf"^[A-Za-z_][A-Za-z0-9_]*[{SPACE}]*[:=][{SPACE}]*[^;]+;?\z",
    rf"^(if|for|while|def|class|import|from)[{SPACE}]+",
    rf"^[A-Za-z_][A-Za-z0-9_]*[{SPACE}]*\([^)]*\)[{SPACE}]*\{{?\z",
    rf"^[A-Za-z_][A-Za-z0-9_]*[{SPACE}]*\.[{SPACE}]*[A-Za-z_][A-Za-z0-9_]*[{SPACE}]*\(",
    r"^<!--[^\n]*-->\z",
    r"^//[^\n]*\z",
    r"^/\*[^\n]*\*/\z",
    r"^#[^\n]*\z",
]
IMAGE_LINE = r"(?i)\.(jpg|jpeg|png|gif|bmp|tiff|svg)([^\p{L}\p{N}_]|\z)|image:|img:"
FIGURE_LINE = rf"(?i)figure[{SPACE}]+\p{{Nd}}+|fig\.[{SPACE}]*\p{{Nd}}+|fig[{SPACE}]+\p{{Nd}}+"


def is_table_line(line: Column) -> Column:
    """Two pipes, two tabs, or two words with a gap between them at the beginning."""
    return (count_of(line, "|") >= 2) | (count_of(line, "\t") >= 2) | line.rlike(rf"^[^{SPACE}]+[{SPACE}]{{2,}}[^{SPACE}]+")


def is_code_line(line: Column) -> Column:
    return line.rlike("|".join(f"(?:{p})" for p in CODE_LINE))


def line_modality_g1(line: Column) -> Column:
    """text, table, code, image or figure; the first rule that holds of a stripped line, text for a blank one."""
    return stripped_modality_g1(strip(line))


def stripped_modality_g1(x: Column) -> Column:
    """The same of a line that is stripped already."""
    return (
        F.when(x == "", "text")
        .when(is_table_line(x), "table")
        .when(is_code_line(x), "code")
        .when(x.rlike(IMAGE_LINE), "image")
        .when(x.rlike(FIGURE_LINE), "figure")
        .otherwise("text")
    )


def code_like_rule(line: Column) -> Column:
    """Number (from 0) of the first rule that a stripped line meets, null for none."""
    out = None
    for k, p in enumerate(CODE_LIKE):
        out = F.when(line.rlike(p), k) if out is None else out.when(line.rlike(p), k)
    return out


def ocr_eligible(width: Column, height: Column) -> Column:
    return (width > 100) & (height > 100)


def is_figure(width: Column, height: Column, ocr_success: Column) -> Column:
    """Neither tiny nor huge, and of a balanced shape or with text on it."""
    ratio = width / F.nullif(height, F.lit(0))
    return (
        F.when((width < 50) | (height < 50), False)
        .when((width > 2000) | (height > 2000), False)
        .when((ratio >= 0.5) & (ratio <= 2.0), True)
        .otherwise(F.coalesce(ocr_success, F.lit(False)))
    )


def figure_type(width: Column, height: Column, ocr_success: Column) -> Column:
    ratio = F.when(height == 0, 0.0).otherwise(width / F.nullif(height, F.lit(0)))
    return F.when(F.coalesce(ocr_success, F.lit(False)), "text_diagram").when(ratio > 1.5, "wide_diagram").when(ratio < 0.7, "tall_diagram").otherwise("standard_figure")


def figure_kind(preview: Column) -> Column:
    low = F.lower(preview)
    return F.when(low.contains("figure"), "Figure Reference").when(low.contains("diagram"), "Diagram").when(low.contains("chart"), "Chart").otherwise("Other")
