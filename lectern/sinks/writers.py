"""Results as files: extracted records, embeddings, reports, galleries."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.statistics import embedding_stats, file_ordinals, image_report


def extracted_files(images: DataFrame, tables: DataFrame, code: DataFrame) -> DataFrame:
    """(document_id, file_name, content): a file for each record: images as JSON, tables as CSV with a JSON of their measures, code as text."""
    i = file_ordinals(images, "image", "json", "image_index").select("document_id", "file_name", F.to_json(F.struct(*images.columns)).alias("content"))
    t = file_ordinals(tables, "table", "csv", "table_index")
    quoted = lambda c: F.when(c.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit("")))
    csv = F.array_join(F.transform("cell_data", lambda r: F.array_join(F.transform(r, quoted), ",")), "\n")
    rows = t.select("document_id", "file_name", F.coalesce(csv, F.lit("")).alias("content"))
    meta = t.select("document_id", F.regexp_replace("file_name", r"\.csv$", "_meta.json").alias("file_name"), F.to_json(F.struct(*[c for c in tables.columns if c != "cell_data"])).alias("content"))
    c = file_ordinals(code, "code", "txt", "chunk_index").select("document_id", "file_name", "content")
    return i.unionByName(rows).unionByName(meta).unionByName(c)


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes (document_id, file_name, content) to folder/document_id/file_name, where all executors reach it; (document_id, file_name, error) comes back, error null where it went well."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pathlib import Path

        for batch in batches:
            errors = []
            for document, name, content in zip(batch["document_id"], batch["file_name"], batch["content"]):
                try:
                    target = Path(folder) / str(document) / name
                    target.parent.mkdir(parents=True, exist_ok=True)
                    target.write_text(content or "", encoding="utf-8")
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield batch[["document_id", "file_name"]].assign(error=errors)

    return files.select("document_id", "file_name", "content").mapInPandas(run, "document_id string, file_name string, error string")


def write_embeddings(chunks: DataFrame, folder: str) -> DataFrame:
    """Vectors by embedding_type as Parquet; comes back with count and dimensions of each type."""
    rows = chunks.where("embedding is not null").withColumn("embedding_type", F.coalesce(F.col("embedding_metadata.embedding_type"), F.lit("unknown")))
    rows.write.mode("overwrite").partitionBy("embedding_type").parquet(folder)
    return embedding_metadata(rows)


def embedding_metadata(chunks: DataFrame) -> DataFrame:
    """(embedding_type, count, dimension): of each type the number of vectors and their greatest length."""
    return chunks.where("embedding is not null").groupBy("embedding_type").agg(F.count("*").alias("count"), F.max(F.size("embedding")).alias("dimension"))


def write_reports(images: DataFrame, folder: str) -> DataFrame:
    return write_files(image_report(images).select("document_id", F.lit("images.md").alias("file_name"), F.col("report").alias("content")), folder)


def gallery(images: DataFrame, data: str | None = None) -> DataFrame:
    """(document_id, html): cards of each document's images, by page, under four totals; data names a binary column of image bytes to embed."""
    source = F.concat(F.lit("<img src='data:image/png;base64,"), F.base64(data), F.lit("'>")) if data else F.lit("")
    card = F.concat(F.format_string("<div class='card'><h3>Page %d, image %d</h3><p>%dx%d, %d bytes</p>", *[F.coalesce(c, F.lit(0)) for c in ("page_number", "image_index", "width", "height", "size_bytes")]), source, F.lit("</div>"))
    pages = images.groupBy("document_id", F.coalesce("page_number", F.lit(0)).alias("page")).agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("width") > F.col("height")).alias("wide"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("image_index", F.lit(0)).alias("i"), card.alias("card")))), lambda x: x["card"]), "\n").alias("cards"))
    whole = pages.groupBy("document_id").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sum("wide").alias("wide"), F.count("*").alias("pages"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "cards"))), lambda x: x["cards"]), "\n").alias("cards"))
    head = F.format_string("<html><body><ul><li>Images: %d</li><li>Pages: %d</li><li>Bytes: %d</li><li>Landscape: %d</li></ul>\n", "n", "pages", "bytes", "wide")
    return whole.select("document_id", F.concat(head, F.col("cards"), F.lit("\n</body></html>")).alias("html"))


def write_images(images: DataFrame, folder: str, data: str = "data") -> DataFrame:
    """Writes the bytes of image records to folder/document_id/page_001_img_001.png; (document_id, file_name, error) comes back. Records without bytes are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pathlib import Path

        for batch in batches:
            errors = []
            for document, name, content in zip(batch["document_id"], batch["file_name"], batch["content"]):
                try:
                    target = Path(folder) / str(document) / name
                    target.parent.mkdir(parents=True, exist_ok=True)
                    target.write_bytes(bytes(content))
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield batch[["document_id", "file_name"]].assign(error=errors)

    name = F.format_string("page_%03d_img_%03d.png", F.coalesce("page_number", F.lit(0)), F.coalesce("image_index", F.lit(0)))
    rows = images.where(F.col(data).isNotNull()).select("document_id", name.alias("file_name"), F.col(data).alias("content"))
    return rows.mapInPandas(run, "document_id string, file_name string, error string")


def image_workflow(images: DataFrame, folder: str, data: str | None = None) -> dict:
    """Images, gallery and report of every document into a folder; returns totals. No images is a result, not an error."""
    written = [write_files(gallery(images, data).select("document_id", F.lit("gallery.html").alias("file_name"), F.col("html").alias("content")), folder), write_reports(images, folder)]
    if data:
        written.append(write_images(images, folder, data))
    out = written[0]
    for w in written[1:]:
        out = out.unionByName(w)
    row = out.agg(F.count("*").alias("files"), F.count("error").alias("failed")).first()
    totals = images.agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("documents"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes")).first()
    return {"success": row.failed == 0, "total_images": totals.n, "documents": totals.documents, "total_bytes": totals.bytes, "files": row.files, "failed": row.failed}


def chart(counts: list[tuple[str, float]], title: str) -> str:
    """A bar chart as SVG, from chart data that has been collected (top-k rows or histogram bins)."""
    top = max((n for _, n in counts), default=0) or 1
    bars = "".join(f"<text x='0' y='{24 * k + 40}'>{html.escape(str(label))}</text><rect x='160' y='{24 * k + 26}' width='{400 * n / top:.1f}' height='18'><title>{n}</title></rect>" for k, (label, n) in enumerate(counts))
    return f"<svg xmlns='http://www.w3.org/2000/svg' width='600' height='{24 * len(counts) + 50}'><text x='0' y='16'>{html.escape(title)}</text>{bars}</svg>"


__all__ = ["chart", "embedding_metadata", "embedding_stats", "extracted_files", "gallery", "image_workflow", "write_embeddings", "write_files", "write_images", "write_reports"]
