"""The whole pipeline: ingest, process, embed, store, summary, as stages of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.errors import require
from lectern.functions.cleaning import clean_doc_g2
from lectern.operators.chunking import chunk_sentence_g2
from lectern.operators.content import code_records, content_chunks, embedding_text
from lectern.operators.embedding import embed_hashing
from lectern.operators.merge import union_chunks
from lectern.operators.statistics import chunk_summary, embedding_stats
from lectern.operators.store import Collection
from lectern.schemas import REQUIRED_SETTINGS, Options

Hook = Callable[[DataFrame], DataFrame]


def clean_documents(documents: DataFrame) -> DataFrame:
    """documents (document_id, content, ...) with cleaned content and its lengths before and after; null content counts as empty."""
    out = documents.withColumn("original_length", F.length(F.coalesce("content", F.lit("")))).withColumn("content", clean_doc_g2(F.col("content")))
    return out.withColumn("cleaned_length", F.length("content"))


def process(documents: DataFrame, options: Options, images: DataFrame | None = None, tables: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """(document_id, type, modality, content, chunk_index, ...): text chunks of cleaned documents, then chunks of extracted content."""
    text = chunk_sentence_g2(clean_documents(documents), size=options.chunk_size, overlap=options.overlap)
    chunks = text.withColumn("type", F.lit("text")).withColumn("page_number", F.lit(0))
    if options.extract_content and images is not None and tables is not None:
        source = pages if pages is not None else documents.select("document_id", F.lit(1).alias("page_number"), "content")
        code = code_records(source)
        chunks = union_chunks(chunks, content_chunks(images, tables, code))
    strategy = "modality_aware" if options.extract_content else "simple"
    return chunks.withColumns({"modality": F.col("type"), "processed": F.lit(True), "content_extraction_enabled": F.lit(options.extract_content), "chunking_strategy": F.lit(strategy)})


def embed(chunks: DataFrame, options: Options) -> DataFrame:
    have = set(chunks.columns)
    get = lambda c: F.col(c) if c in have else F.lit(None)
    text = embedding_text(F.col("type"), F.col("content"), get("width"), get("height"), get("rows"), get("columns"), get("figure_type").cast("string"))
    return embed_hashing(chunks.withColumn("_text", text), "_text", options.dimension).drop("_text")


@dataclass
class Pipeline:
    """Builder of a run. Stages can be hooked: hook("chunks", f) puts f behind the stage of that name."""

    spark: SparkSession
    options: Options = field(default_factory=Options)
    hooks: dict[str, list[Hook]] = field(default_factory=dict)

    def with_options(self, **changes) -> Pipeline:
        self.options = replace(self.options, **changes)
        return self

    def with_settings(self, settings: dict) -> Pipeline:
        """Settings of a configuration; the required ones must be there."""
        require(settings, REQUIRED_SETTINGS)
        return self.with_options(settings=settings)

    def hook(self, stage: str, f: Hook) -> Pipeline:
        self.hooks.setdefault(stage, []).append(f)
        return self

    def _after(self, stage: str, df: DataFrame) -> DataFrame:
        for f in self.hooks.get(stage, []):
            df = df.transform(f)
        return df

    def plan(self, documents: DataFrame, images: DataFrame | None = None, tables: DataFrame | None = None) -> dict[str, DataFrame]:
        """The stages as lazy DataFrames: documents, chunks, embedded."""
        docs = self._after("documents", documents.where("document_id is not null"))
        chunks = self._after("chunks", process(docs, self.options, images, tables))
        out = {"documents": docs, "chunks": chunks}
        if self.options.generate_embeddings:
            out["embedded"] = self._after("embedded", embed(chunks, self.options))
        return out

    def run(self, documents: DataFrame, images: DataFrame | None = None, tables: DataFrame | None = None, collection: Collection | None = None) -> dict:
        """Runs all stages and returns a summary. Chunks are embedded once, on their way into the collection; counts are observed on the way."""
        stages = self.plan(documents, images, tables)
        summary: dict = {"success": True, "stages": [{"node": "ingest", "success": True}]}
        last = stages.get("embedded", stages["chunks"])
        if self.options.store_chunks and collection is not None:
            seen = Observation("chunks")
            embedded = F.count("embedding") if "embedding" in last.columns else F.sum(F.lit(0))
            result = collection.store(last.observe(seen, F.count("*").alias("chunks"), embedded.alias("embedded"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("chars")))
            summary |= {"total_chunks": seen.get["chunks"], "embedded_chunks": seen.get["embedded"] or 0, "stored": result}
        else:
            row = chunk_summary(last).agg(F.sum("total_chunks").alias("n")).first()
            summary |= {"total_chunks": row.n or 0, "stored": None}
        summary["total_documents"] = stages["documents"].select("document_id").distinct().count()
        for node, n in (("process", summary["total_chunks"]), ("embed", summary.get("embedded_chunks")), ("store", (summary["stored"] or {}).get("stored_chunks"))):
            if n is not None:
                summary["stages"].append({"node": node, "success": n > 0} | ({} if n else {"error": "no chunks"}))
        summary["success"] = all(s["success"] for s in summary["stages"])
        return summary


def document_summary(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """(document_id, original_length, cleaned_length, total_chunks, text_chunks, other_chunks) of every document."""
    docs = clean_documents(documents).select("document_id", "original_length", "cleaned_length")
    n = chunks.groupBy("document_id").agg(F.count("*").alias("total_chunks"), F.count_if(F.col("type") == "text").alias("text_chunks"))
    out = docs.join(n, "document_id", "left").na.fill(0, ["total_chunks", "text_chunks"])
    return out.withColumn("other_chunks", F.col("total_chunks") - F.col("text_chunks"))


def final_summary(documents: DataFrame, chunks: DataFrame, embedded: DataFrame) -> DataFrame:
    """One row: total_documents, total_chunks, embedded_chunks, stored_chunks and the mean length of the vectors."""
    d = documents.agg(F.countDistinct("document_id").alias("total_documents"))
    c = chunks.agg(F.count("*").alias("total_chunks"))
    e = embedded.agg(F.count("embedding").alias("embedded_chunks"), F.count_if((F.length("content") > 0) & F.col("embedding").isNotNull()).alias("stored_chunks"))
    return d.crossJoin(c).crossJoin(e)  # one row each


__all__ = ["Pipeline", "clean_documents", "document_summary", "embed", "embedding_stats", "final_summary", "process"]
