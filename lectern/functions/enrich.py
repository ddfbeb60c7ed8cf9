"""Metadata of chunks: measures and flags of both generations as Columns over content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import ALNUM, DIGIT, SPACE, is_upper, lines, lstrip, not_blank, strip, words

# What makes content likely code, and what begins a list item.
CODE_SIGNS = ["def ", "class ", "import ", "from ", "if __name__", "try:", "except:", "with ", "for ", "while ", "return ", "print(", "len(", "range("]
LIST_SIGNS = ["-", "*", "•", "1.", "2.", "3."]
IMAGE_TYPES = r"(?i)\.(jpg|jpeg|png|gif|bmp|tiff|svg)\b"


def n_words(c: Column) -> Column:
    return F.size(words(c))


def n_sentences(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\.", -1), not_blank))


def any_line(c: Column, test) -> Column:
    return F.exists(lines(c), test)


def base_g2(c: Column) -> dict[str, Column]:
    return {"content_length": F.length(c), "word_count": n_words(c), "enriched": F.lit(True)}


def text_g2(c: Column) -> dict[str, Column]:
    total = F.length(F.array_join(words(c), ""))
    return {
        "sentence_count": n_sentences(c),
        "paragraph_count": F.size(F.filter(F.split(c, "\n\n", -1), not_blank)),
        "has_numbers": c.rlike(f"[{DIGIT}]"),
        "has_special_chars": c.rlike(f"[^{ALNUM} ]"),
        "avg_word_length": total / F.greatest(n_words(c), F.lit(1)),
    }


def table_g2(c: Column) -> dict[str, Column]:
    rows = F.filter(lines(c), lambda x: x.contains("|"))
    return {
        "row_count": F.size(rows),
        "column_count": F.coalesce(F.array_max(F.transform(rows, lambda x: F.size(F.split(x, r"\|", -1)))), F.lit(0)),
        "has_header": F.exists(rows, lambda x: F.exists(F.split(x, r"\|", -1), is_upper)),
        "has_numeric_data": c.rlike(f"[{DIGIT}]"),
    }


def has_caption(c: Column) -> Column:
    low = F.lower(c)
    return low.contains("caption") | low.contains("figure")


def image_g2(c: Column) -> dict[str, Column]:
    return {"content_type": F.lit("image"), "has_caption": has_caption(c), "caption_length": F.length(c)}


def figure_type_g2(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.rlike("chart|graph"), "chart").when(low.contains("diagram"), "diagram").when(low.rlike("photo|image"), "image").otherwise("unknown")


def figure_g2(c: Column) -> dict[str, Column]:
    return {"content_type": F.lit("figure"), "has_caption": has_caption(c), "caption_length": F.length(c), "figure_type": figure_type_g2(c)}


def code_language(c: Column) -> Column:
    low = F.lower(c)
    has = low.contains
    return (
        F.when(has("def ") & has("import "), "python")
        .when(has("function ") & has("var "), "javascript")
        .when(has("public class") | has("private "), "java")
        .when(has("<?php"), "php")
        .when(has("def "), "python")
        .otherwise("unknown")
    )


def code_flags(c: Column) -> dict[str, Column]:
    return {"has_comments": any_line(c, lambda x: strip(x).startswith("#")), "has_functions": c.contains("def "), "has_classes": c.contains("class ")}


def code_g2(c: Column) -> dict[str, Column]:
    return {"line_count": F.size(lines(c)), **code_flags(c), "estimated_language": code_language(c)}


def hash_g1(c: Column) -> dict[str, Column]:
    return {"content_hash": F.sha2(c, 256)}


def length_g1(c: Column) -> dict[str, Column]:
    n = n_words(c)
    return {"content_length": F.length(c), "word_count": n, "line_count": F.size(lines(c)), "average_word_length": F.when(n > 0, F.length(c) / F.nullif(n, F.lit(0))).otherwise(0.0)}


def likely_code(c: Column) -> Column:
    out = F.lit(False)
    for sign in CODE_SIGNS:
        out = out | c.contains(sign)
    return out


def likely_table(c: Column) -> Column:
    return c.contains("\n") & (c.contains("|") | c.contains("\t"))


def likely_list(c: Column) -> Column:
    starts = lambda x: x.rlike(rf"^[{SPACE}]*(?:[-*•]|[123]\.)")
    return F.size(F.filter(lines(c), starts)) >= F.size(lines(c)) * 0.5


def complexity(c: Column) -> Column:
    """Words a sentence over 20, at most 1, to three decimals (half to even); 0 where there is no sentence."""
    n = n_sentences(c)
    return F.when(n > 0, F.bround(F.least(n_words(c) / F.nullif(n, F.lit(0)) / 20.0, F.lit(1.0)), 3)).otherwise(0.0)


def semantic_g1(c: Column) -> dict[str, Column]:
    return {
        "has_numbers": c.rlike(f"[{DIGIT}]"),
        "has_special_chars": c.rlike(f"[^{ALNUM}{SPACE}]"),
        "is_likely_code": likely_code(c),
        "is_likely_table": likely_table(c),
        "is_likely_list": likely_list(c),
        "complexity_score": complexity(c),
    }


def table_g1(c: Column) -> dict[str, Column]:
    first = lines(c)[0]
    return {
        "table_rows": F.size(lines(c)),
        "has_header": first.contains("|") | first.contains("\t"),
        "separator_type": F.when(c.contains("|"), "pipe").when(c.contains("\t"), "tab").otherwise("space"),
    }


def indentation(c: Column) -> Column:
    wide = F.transform(F.filter(lines(c), not_blank), lambda x: F.length(x) - F.length(lstrip(x)))
    return F.floor(F.coalesce(F.array_max(wide), F.lit(0)) / 4).cast("int")


def code_g1(c: Column) -> dict[str, Column]:
    return {"code_lines": F.size(lines(c)), "indentation_level": indentation(c), **code_flags(c)}


def image_g1(c: Column) -> dict[str, Column]:
    found = F.regexp_extract_all(c, F.lit(IMAGE_TYPES), F.lit(1))
    return {"image_count": F.size(found), "image_types": F.array_sort(F.array_distinct(found)), "has_caption": has_caption(c)}


def _struct_when(modality: Column, name: str, fields: dict[str, Column]) -> Column:
    return F.when(modality == name, F.struct(*[v.alias(k) for k, v in fields.items()]))


def enrich_g2(chunks: DataFrame) -> DataFrame:
    """Chunks with base measures and, by modality, a struct of its own measures; null content counts as empty."""
    c, m = F.coalesce("content", F.lit("")), F.col("modality")
    own = {"text": text_g2(c), "table": table_g2(c), "image": image_g2(c), "figure": figure_g2(c), "code": code_g2(c)}
    return chunks.withColumns({**base_g2(c), **{f"{k}_metadata": _struct_when(m, k, v) for k, v in own.items()}})


def enrich_g1(chunks: DataFrame) -> DataFrame:
    """Chunks with hash, lengths and semantic flags, then the block of the modality; later keys overwrite, so has_caption and the like are null elsewhere. Text and figures have no block."""
    c, m = F.coalesce("content", F.lit("")), F.col("modality")
    own = {"table": table_g1(c), "code": code_g1(c), "image": image_g1(c)}
    return chunks.withColumns({**hash_g1(c), **length_g1(c), **semantic_g1(c), **{f"{k}_metadata": _struct_when(m, k, v) for k, v in own.items()}})
