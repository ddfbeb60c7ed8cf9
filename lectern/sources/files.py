"""Files as documents: routing by kind, ids, and page texts of PDFs where a parser is installed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSION = r"\.([^./]*)\z"


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, EXTENSION, 1))


def stem(path: Column) -> Column:
    """The file name without its last extension; a name that begins with its only dot is kept."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")


def route(path: Column) -> Column:
    """Which reader takes a file: pdf, text (plain text and HTML, an extension), or none."""
    s = suffix(path)
    return F.when(s == "pdf", "pdf").when(s.isin("txt", "html", "htm"), "text").otherwise("none")


def dispatch(files: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """files that a reader takes (with `reader`), and (path, category, message) of the others."""
    rows = files.withColumn("reader", route(F.col(path)))
    errors = rows.where("reader = 'none'").select(F.col(path).alias("path"), F.lit("ingestion").alias("category"), F.concat(F.lit("no reader for "), F.coalesce(F.col(path), F.lit("null"))).alias("message"))
    return rows.where("reader <> 'none'"), errors


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files below a folder, without their contents."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return rows.select("path", "length", "modificationTime")


def valid_files(wanted: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of wanted (path) the files that are there with contents, and (path, category, message) of the others; a listing doesn't show empty files."""
    there = files.where("length > 0")
    errors = wanted.join(there, "path", "left_anti").select("path", F.lit("validation").alias("category"), F.lit("missing or empty file").alias("message"))
    return there.join(wanted.select("path").distinct(), "path", "left_semi"), errors


def pdf_documents(files: DataFrame) -> DataFrame:
    """(document_id, path, document_type, processing_status) of PDF files; the id is made of the stem and the second of the last change."""
    stamp = F.unix_seconds(F.col("modificationTime").cast("timestamp"))
    return files.where(suffix(F.col("path")) == "pdf").select(F.concat(F.lit("pdf_"), stem(F.col("path")), F.lit("_"), stamp.cast("string")).alias("document_id"), "path", F.lit("pdf").alias("document_type"), F.lit("ingested").alias("processing_status"))


def text_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(document_id, path, content) of text and HTML files, each read whole; HTML loses its markup."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,html,htm}").text(folder, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    html = F.regexp_replace(F.regexp_replace("value", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    return rows.select(F.concat(F.lit("txt_"), stem(F.col("path"))).alias("document_id"), "path", F.when(suffix(F.col("path")) == "txt", F.col("value")).otherwise(html).alias("content"))


def page_text(pages: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, content): the texts of a document's pages in order, each followed by a line feed; null texts count as empty."""
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce("page_number", F.lit(0)).alias("p"), F.coalesce("content", F.lit("")).alias("t"))))
    return pages.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: F.concat(x["t"], F.lit("\n"))), "").alias("content"))


def pdf_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(path, page_number, content, error) of the PDFs below a folder. Needs an optional parser in the workers; a file that fails gives one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import fitz
        except ImportError:
            fitz = None
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    if fitz is None:
                        raise RuntimeError("no PDF parser is installed")
                    with fitz.open(stream=bytes(content), filetype="pdf") as doc:
                        out += [(path, n, page.get_text(), None) for n, page in enumerate(doc, 1)]
                except Exception as e:
                    out.append((path, None, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "page_number", "content", "error"])

    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)
    return rows.select("path", "content").mapInPandas(run, "path string, page_number int, content string, error string")


def document_id_parts(document_id: Column) -> Column:
    """The file name in an id such as pdf_name_1700000000: without prefix and stamp, with .pdf."""
    return F.concat(F.regexp_replace(F.regexp_replace(document_id, "^pdf_", ""), r"_[^_]*\z", ""), F.lit(".pdf"))


def store_id(path: Column) -> Column:
    """The id under which a document is stored: its path with slashes and dots as underscores."""
    return F.translate(path, "/.", "__")


def document_label(document_id: Column) -> Column:
    return F.substring_index(document_id, "_", 1)
