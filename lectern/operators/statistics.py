"""Counts and summaries of chunks, extractions, embeddings and collections, and the data behind charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The categories under which errors are counted.
ERROR_CATEGORIES = ["ingestion", "processing", "chunking", "cleaning", "enrichment", "configuration", "validation", "other"]


def count_by(df: DataFrame, column: Column | str, name: str) -> DataFrame:
    """(name, n): rows by value; null counts as unknown."""
    c = F.col(column) if isinstance(column, str) else column
    return df.groupBy(F.coalesce(c, F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))


def count_map(df: DataFrame, column: str) -> DataFrame:
    """One row: a map of counts by value, for columns of few values such as kinds of chunks."""
    counts = count_by(df, column, "k")
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("counts"))


def chunk_summary(chunks: DataFrame, by: list[str] | None = None, kind: str = "type") -> DataFrame:
    """Totals of chunks, of text length (of text chunks) and of each other kind; one row, or one for each value of `by`."""
    is_ = lambda k: F.count_if(F.col(kind) == k).alias(f"total_{k}s" if k != "code" else "total_code_chunks")
    length = F.coalesce(F.sum(F.when(F.col(kind) == "text", F.length(F.coalesce("content", F.lit(""))))), F.lit(0)).alias("total_text_length")
    return chunks.groupBy(*(by or [])).agg(F.count("*").alias("total_chunks"), length, is_("image"), is_("table"), is_("code"), is_("figure"))


def extraction_totals(records: DataFrame, kind: str = "kind") -> DataFrame:
    """(document_id, kind, total, pages): records and pages with any, a page counted once."""
    return records.groupBy("document_id", kind).agg(F.count("*").alias("total"), F.countDistinct("page_number").alias("pages"))


def extraction_summary(images: DataFrame, tables: DataFrame, pages: DataFrame) -> DataFrame:
    """(document_id, total_pages, images, image_pages, with_ocr_text, tables, table_pages, total_cells, image_rate, table_rate).

    pages: (document_id, page_count), one row for each document that comes out. Rates are records a page and may exceed 1.
    """
    i = images.groupBy("document_id").agg(F.count("*").alias("images"), F.countDistinct("page_number").alias("image_pages"), F.count_if("ocr_success").alias("with_ocr_text"))
    t = tables.groupBy("document_id").agg(F.count("*").alias("tables"), F.countDistinct("page_number").alias("table_pages"), F.sum(F.coalesce("total_cells", F.lit(0))).alias("total_cells"))
    both = pages.join(i, "document_id", "left").join(t, "document_id", "left")
    names = ["images", "image_pages", "with_ocr_text", "tables", "table_pages", "total_cells"]
    n = F.greatest(F.coalesce("page_count", F.lit(0)), F.lit(1))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in names]
    return both.select("document_id", F.coalesce("page_count", F.lit(0)).alias("total_pages"), *counts, (F.coalesce("images", F.lit(0)) / n).alias("image_rate"), (F.coalesce("tables", F.lit(0)) / n).alias("table_rate"))


def embedding_stats(chunks: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: number, mean, least, greatest and population deviation of the vectors' lengths; no row where there is none."""
    n = F.size(vector)
    out = chunks.where(F.col(vector).isNotNull()).agg(F.count("*").alias("total"), F.avg(n).alias("mean_length"), F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.stddev_pop(n).alias("std_length"))
    return out.where("total > 0")


def embed_node_stats(chunks: DataFrame, order: list[str], vector: str = "embedding") -> DataFrame:
    """One row: processed, embedded, and the dimension of the first embedded chunk in `order`, or 0."""
    first = F.min(F.when(F.col(vector).isNotNull(), F.struct(*order, F.size(vector).alias("d"))))
    return chunks.agg(F.count("*").alias("chunks_processed"), F.count(vector).alias("chunks_embedded"), F.coalesce(first["d"], F.lit(0)).alias("embedding_dimension"))


def image_stats(images: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Images, pages, bytes, mean bytes, landscape (wider than high) and portrait (the rest)."""
    return images.groupBy(*(by or [])).agg(
        F.count("*").alias("total_images"),
        F.countDistinct("page_number").alias("pages"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
        F.avg("size_bytes").alias("average_bytes"),
        F.count_if(F.col("width") > F.col("height")).alias("landscape"),
        F.count_if(F.col("width") <= F.col("height")).alias("portrait"),
    )


def argmax_document(counts: DataFrame, key: str = "document_id", n: str = "n") -> DataFrame:
    """The document with the greatest positive count, the first in key order among equals."""
    return counts.where(F.col(n) > 0).orderBy(F.desc(n), key).limit(1)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, low, high, n): equal-width bins between the least and the greatest value, the last closed on the right; empty bins too.

    Nulls are left out. Where all values are equal the range is widened by half on either side.
    """
    v = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    ends = v.agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a is not null").select(F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("a"), F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("b"))
    place = F.least(F.floor((F.col("v") - F.col("a")) / ((F.col("b") - F.col("a")) / bins)), F.lit(bins - 1)).cast("int")
    counts = v.crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))  # ends is one row
    width = (F.col("b") - F.col("a")) / bins
    frame = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "a", "b").select("bin", (F.col("a") + F.col("bin") * width).alias("low"), (F.col("a") + (F.col("bin") + 1) * width).alias("high"))
    return frame.join(counts, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def value_counts(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def percent(counts: DataFrame, n: str = "n") -> DataFrame:
    """counts with share, in percent of the total; 0 where the total is 0."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", F.when(F.col("_total") > 0, F.col(n) * 100.0 / F.nullif("_total", F.lit(0))).otherwise(0.0)).drop("_total")


def top_documents(counts: DataFrame, key: str = "document_id", n: str = "n", k: int = 10) -> DataFrame:
    """The k documents with the greatest counts, ties in key order, with the label before the key's first underscore."""
    return counts.orderBy(F.desc(n), key).limit(k).withColumn("label", F.substring_index(key, "_", 1))


def content_summary(chunks: DataFrame, kind: str = "type", key: str = "document_id") -> DataFrame:
    """One row of counts of tables, figures, texts and code, and of documents with figures and with tables; a document with both counts twice in total_documents."""
    n = lambda k: F.count_if(F.col(kind) == k)
    docs = lambda k: F.countDistinct(F.when(F.col(kind) == k, F.col(key)))
    return chunks.agg(n("table").alias("total_tables"), n("figure").alias("total_figures"), n("text").alias("total_text"), n("code").alias("total_code"), docs("figure").alias("documents_with_figures"), docs("table").alias("documents_with_tables")).withColumn("total_documents", F.col("documents_with_figures") + F.col("documents_with_tables"))


def error_counts(errors: DataFrame, category: str = "category") -> DataFrame:
    """(category, n) for all eight categories, those without an error too; unknown and null categories count as other."""
    named = F.when(F.col(category).isin(ERROR_CATEGORIES), F.col(category)).otherwise("other")
    counts = errors.groupBy(named.alias("category")).agg(F.count("*").alias("n"))
    frame = errors.sparkSession.createDataFrame([(c,) for c in ERROR_CATEGORIES], "category string")
    return frame.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


def error_summary(errors: DataFrame, category: str = "category") -> DataFrame:
    counts = error_counts(errors, category)
    return counts.agg(F.sum("n").alias("total_errors"), (F.sum("n") > 0).alias("has_errors"))


def preview(content: Column, n: int = 100) -> Column:
    return F.when(F.length(content) > n, F.concat(F.substring(content, 1, n), F.lit("..."))).otherwise(content)


def image_report(images: DataFrame) -> DataFrame:
    """(document_id, report): a Markdown report of each document's images, totals first, then the pages in order.

    A page's lines are put together before a document's, so the rows that meet in one group are pages, not images.
    """
    line = F.format_string("- Image %d: %dx%d, %d bytes", F.coalesce("image_index", F.lit(0)), F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0)), F.coalesce("size_bytes", F.lit(0)))
    pages = images.groupBy("document_id", F.coalesce("page_number", F.lit(0)).alias("page")).agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("image_index", F.lit(0)).alias("i"), line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    section = F.concat(F.format_string("## Page %d (%d images)\n", "page", "n"), F.col("body"))
    whole = pages.groupBy("document_id").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("pages"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", section.alias("s")))), lambda x: x["s"]), "\n\n").alias("body"))
    return whole.select("document_id", F.concat(F.format_string("# Images\n\n- Total: %d\n- Pages with images: %d\n- Bytes: %d\n\n", "n", "pages", "bytes"), F.col("body")).alias("report"))


def file_ordinals(records: DataFrame, prefix: str, suffix: str, index: str) -> DataFrame:
    """records with ordinal (from 1 in each document, in page order) and file_name such as image_001_page_002.json."""
    order = W.partitionBy("document_id").orderBy(F.coalesce("page_number", F.lit(0)), F.coalesce(index, F.lit(0)))
    return records.withColumn("ordinal", F.row_number().over(order)).withColumn("file_name", F.format_string(f"{prefix}_%03d_page_%03d.{suffix}", "ordinal", F.coalesce("page_number", F.lit(0))))
