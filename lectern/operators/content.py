"""Records of images, tables, figures and code, and the chunks made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.detect import code_like_rule, figure_type, is_figure
from lectern.functions.text import lines, not_blank, pinned, strip

RULE = "=" * 50


def table_stats(cells: Column) -> dict[str, Column]:
    """rows, columns (of the first row), total_cells, non_empty_cells of an array of rows of cells; null cells are empty."""
    rows = F.coalesce(cells, F.array().cast("array<array<string>>"))
    filled = F.transform(rows, lambda r: F.size(F.filter(r, lambda c: F.coalesce(strip(c), F.lit("")) != "")))
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    return {
        "rows": F.size(rows),
        "columns": F.when(F.size(rows) > 0, F.size(F.get(rows, F.lit(0)))).otherwise(0),
        "total_cells": add(F.transform(rows, lambda r: F.greatest(F.size(r), F.lit(0)))),
        "non_empty_cells": add(filled),
    }


def table_row_text(row: Column) -> Column:
    return F.array_join(F.filter(row, lambda c: F.coalesce(c, F.lit("")) != ""), " | ")


def table_to_text(cells: Column) -> Column:
    """A heading, a rule and the rows' non-empty cells; the empty string for no rows."""
    body = F.filter(F.transform(cells, table_row_text), not_blank)
    return F.when(F.coalesce(F.size(cells), F.lit(0)) <= 0, "").otherwise(F.array_join(F.concat(F.array(F.lit("Table Content:"), F.lit(RULE)), body), "\n"))


def figures(images: DataFrame) -> DataFrame:
    """The image records that are figures, with figure_type."""
    args = F.col("width"), F.col("height"), F.col("ocr_success")
    return images.where(is_figure(*args)).withColumn("figure_type", figure_type(*args))


def code_records(pages: DataFrame, key: str = "document_id", page: str = "page_number", text: str = "content") -> DataFrame:
    """(key, page, chunk_index, type, content, lines, characters, code_type, line_details): code found in a page's text.

    Fenced blocks first, then inline code (also inside fences), then all code-like lines as one record; chunk_index
    counts from 1 on each page. Null texts give nothing. Repeated (key, page) rows are numbered each by itself.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    blank = F.lit(None).cast("array<struct<line_number:int,content:string,rule:int>>")

    def record(kind: str, content: Column, n: Column, chars: Column, code_type: str, details: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), content.alias("content"), n.alias("lines"), chars.alias("characters"), F.lit(code_type).alias("code_type"), details.alias("line_details"))

    found = lambda kind, pattern, group: F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(group)), lambda c: record(kind, c, F.size(lines(c)), F.length(c), "structured", blank))
    numbered = F.transform("_stripped", lambda x, i: F.struct((i + 1).alias("line_number"), x.alias("content"), code_like_rule(x).alias("rule")))
    like = F.filter(numbered, lambda x: (x["content"] != "") & x["rule"].isNotNull())
    both = pinned(pinned(pages, _stripped=F.transform(lines(t), strip)), _like=like).select(key, page, F.concat(found("markdown_code_block", r"```[\s\S]*?```", 0), found("inline_code", r"`([^`]+)`", 1)).alias("_s"), "_like")
    joined = F.transform("_like", lambda x: x["content"])
    loose = F.when(F.size("_like") > 0, F.array(record("code_like_lines", F.array_join(joined, "\n"), F.size("_like"), F.length(F.array_join(joined, "")), "pattern_matched", F.col("_like")))).otherwise(F.expr("array()"))
    each = both.select(key, page, F.posexplode(F.concat("_s", loose)).alias("_i", "r"))
    return each.select(key, page, (F.col("_i") + 1).alias("chunk_index"), "r.*")


def _running(rows: list[DataFrame], key: str) -> DataFrame:
    order = W.partitionBy(key).orderBy("kind_no", "page_number", "item_index", "content")
    return reduce(lambda a, b: a.unionByName(b), rows).withColumn("chunk_index", (F.row_number().over(order) - 1).cast("int"))


def content_chunks(images: DataFrame, tables: DataFrame, code: DataFrame, key: str = "document_id") -> DataFrame:
    """(document_id, chunk_index, type, content, page_number, item_index, width, height, ocr_success, size_bytes, rows, columns, total_cells, non_empty_cells, code_type, lines, characters, figure_type).

    One chunk for each image, table, code record and figure, in this order, numbered from 0 through all kinds of a
    document. Missing measures are 0, missing texts empty.
    """
    zero, none = F.lit(0), F.lit(None).cast("string")
    names = ["width", "height", "size_bytes", "rows", "columns", "total_cells", "non_empty_cells", "lines", "characters"]

    def shape(df: DataFrame, kind: str, no: int, content: Column, index: Column, **own: Column) -> DataFrame:
        numbers = [F.coalesce(own.get(n, F.lit(None)).cast("bigint"), zero.cast("bigint")).alias(n) for n in names]
        texts = [own.get(n, none).alias(n) for n in ("code_type", "figure_type")]
        return df.select(key, F.lit(no).alias("kind_no"), F.lit(kind).alias("type"), F.coalesce(content, F.lit("")).alias("content"), F.coalesce("page_number", zero).alias("page_number"), F.coalesce(index, zero).alias("item_index"), own.get("ocr_success", F.lit(None).cast("boolean")).alias("ocr_success"), *numbers, *texts)

    look = {"width": F.col("width"), "height": F.col("height"), "size_bytes": F.col("size_bytes"), "ocr_success": F.coalesce("ocr_success", F.lit(False))}
    size = {"rows": F.col("n_rows"), "columns": F.col("n_cols"), "total_cells": F.col("total_cells"), "non_empty_cells": F.col("non_empty_cells")}
    parts = [
        shape(images, "image", 0, F.col("extracted_text"), F.col("image_index"), **look),
        shape(tables, "table", 1, table_to_text(F.col("cell_data")), F.col("table_index"), **size),
        shape(code, "code", 2, F.col("content"), F.col("chunk_index"), code_type=F.col("type"), lines=F.col("lines"), characters=F.col("characters")),
        shape(figures(images), "figure", 3, F.col("extracted_text"), F.col("image_index"), **look, figure_type=F.col("figure_type")),
    ]
    return _running(parts, key).drop("kind_no")


def join_enrich_lookup(chunks: DataFrame, images: DataFrame, tables: DataFrame, code: DataFrame) -> DataFrame:
    """Chunks (document_id, type, chunk_index, ...) with the measures of the first record whose index equals chunk_index.

    Left outer: chunks without a match, figures among them, keep nulls. The index compared is the record's own per-page
    index, as in the engine this one stands in for; the first record in page order wins.
    """
    def first(df: DataFrame, kind: str, index: str, fields: dict[str, Column]) -> DataFrame:
        order = F.struct(F.coalesce("page_number", F.lit(0)).alias("p"), *[v.alias(k) for k, v in fields.items()])
        one = df.select("document_id", F.lit(kind).alias("type"), F.col(index).alias("chunk_index"), order.alias("o")).where("chunk_index is not null").groupBy("document_id", "type", "chunk_index").agg(F.min("o").alias("o"))
        return one.select("document_id", "type", "chunk_index", *[F.col(f"o.{k}").alias(k) for k in fields])

    zero = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))
    dims = F.concat_ws("x", zero("width").cast("string"), zero("height").cast("string"))
    found = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            first(images, "image", "image_index", {"found_ocr_success": F.coalesce("ocr_success", F.lit(False)), "image_dimensions": dims, "image_size_bytes": zero("size_bytes")}),
            first(tables, "table", "table_index", {"table_rows": zero("n_rows"), "table_columns": zero("n_cols"), "table_cells": zero("total_cells")}),
            first(code, "code", "chunk_index", {"found_code_type": F.coalesce("type", F.lit("unknown")), "code_lines": zero("lines"), "code_characters": zero("characters")}),
        ],
    )
    return chunks.join(found, ["document_id", "type", "chunk_index"], "left")


def embedding_text(kind: Column, content: Column, width: Column, height: Column, rows: Column, columns: Column, figure_type: Column) -> Column:
    """What is embedded: the content, or for empty images, tables and figures a description of their measures."""
    number = lambda c: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).cast("string")
    dims = F.concat(number(width), F.lit("x"), number(height))
    return (
        F.when(F.coalesce(content, F.lit("")) != "", content)
        .when(kind == "image", F.concat(F.lit("Image with dimensions "), dims))
        .when(kind == "table", F.concat(F.lit("Table with "), number(rows), F.lit(" rows and "), number(columns), F.lit(" columns")))
        .when(kind == "figure", F.concat(F.coalesce(figure_type, F.lit("unknown")), F.lit(" figure with dimensions "), dims))
        .otherwise("")
    )


def embedding_type(kind: Column) -> Column:
    return F.when(kind == "image", "image_ocr").when(kind.isin("text", "table", "code", "figure"), kind)


def known_types(chunks: DataFrame, kind: str = "type") -> DataFrame:
    """Chunks of the five known types with type_order, the order in which they are embedded; others are left out."""
    order = F.array_position(F.array(*[F.lit(k) for k in ("text", "image", "table", "code", "figure")]), F.col(kind))
    return chunks.withColumn("type_order", order.cast("int")).where("type_order > 0")
