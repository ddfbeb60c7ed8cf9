"""Chunkers and segmentation: from documents to chunks.

The chunkers' cursor depends on the text before it, so they run over Arrow batches; what surrounds them is declarative.
Where a boundary would not move the cursor forward, the next chunk begins at the boundary, so every text ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.detect import stripped_modality_g1
from lectern.functions.text import lines, not_blank, pinned, strip

#: Boundaries of sentences in the order in which they are looked for.
SENTENCE_ENDS = (". ", "! ", "? ", "\n\n")
ATOMIC = ("table", "image", "figure")


def sentence_spans(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, end) of windows that end behind the last boundary of the first kind found; end may lie beyond the text."""
    at, n = 0, len(text)
    while at < n:
        end = at + size
        if end < n:
            for mark in SENTENCE_ENDS:
                found = text.rfind(mark, at, end)
                if found > at:
                    end = found + len(mark)
                    break
        yield at, end
        at = end - overlap if end - overlap > at else end


def word_spans(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, end) of windows that end before the last blank."""
    at, n = 0, len(text)
    while at < n:
        end = at + size
        if end < n:
            blank = text.rfind(" ", at, end)
            if blank > at:
                end = blank
        yield at, end
        at = end - overlap if end - overlap > at else end


def _windows(rows: DataFrame, keys: list[str], text: str, spans: Callable[[str, int, int], Iterator[tuple[int, int]]], size: int, overlap: int) -> DataFrame:
    if size <= 0 or overlap < 0:
        raise ValueError("size must be positive and overlap not negative")
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, chunk, start, end, content = [], [], [], [], []
            for k, value in enumerate(batch.column(len(keys)).to_pylist()):
                n = 0
                for a, b in spans(value or "", size, overlap):
                    part = value[a:b].strip()
                    if part:
                        row.append(k), chunk.append(n), start.append(a), end.append(b), content.append(part)
                        n += 1
            take = pa.array(row, pa.int32())
            ints = [pa.array(x, pa.int32()) for x in (chunk, start, end, [len(c) for c in content])]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(len(keys))), pa.array(content, pa.string()), *ints], names=[*keys, "content", "chunk_index", "start_index", "end_index", "length"])

    return rows.select(*keys, text).mapInArrow(run, f"{schema}, content string, chunk_index int, start_index int, end_index int, length int")


def chunk_sentence_g2(documents: DataFrame, key: str | list[str] = "document_id", text: str = "content", size: int = 1000, overlap: int = 200) -> DataFrame:
    """(key, content, chunk_index, start_index, end_index, length): sentence-aware windows; blank ones are left out and take no index.

    key may be several columns, which every chunk carries. Null and empty texts give no chunk; positions count code
    points; end_index may exceed the text's length.
    """
    return _windows(documents, [key] if isinstance(key, str) else key, text, sentence_spans, size, overlap)


def chunk_word_g1(documents: DataFrame, keys: list[str] | None = None, text: str = "content", size: int = 500, overlap: int = 200) -> DataFrame:
    """The same with windows that end before a blank."""
    return _windows(documents, keys or ["document_id"], text, word_spans, size, overlap)


def seg_lines_g1(documents: DataFrame, key: str = "document_id", text: str = "content") -> DataFrame:
    """(key, segment_no, modality, content, start_line, end_line): runs of lines of one modality, those of white space only left out.

    A document that begins with text has a line feed before its first segment. A document's lines stay one row until
    they are labelled, so labelling needs no shuffle; the runs are found by folding over the array of labels.
    """
    parts = lines(F.coalesce(F.col(text), F.lit("")))
    split = documents.select(F.col(key), parts.alias("_l"))
    labelled = pinned(pinned(split, _s=F.transform("_l", strip)), _m=F.transform("_s", stripped_modality_g1)).drop("_s")
    # positions at which a run begins; the state before the first line is text
    begins = F.filter(F.sequence(F.lit(0), F.size("_m") - 1), lambda i: (i == 0) | (F.get("_m", i) != F.get("_m", i - 1)))
    runs = pinned(labelled, _b=begins).select(key, "_l", "_m", "_b", F.posexplode("_b").alias("_k", "start_line"))
    ends = F.coalesce(F.get("_b", F.col("_k") + 1), F.size("_l")) - 1
    body = F.array_join(F.slice("_l", F.col("start_line") + 1, ends - F.col("start_line") + 1), "\n")
    modality = F.get("_m", F.col("start_line"))
    lead = F.when((F.col("start_line") == 0) & (modality == "text"), "\n").otherwise("")
    out = runs.select(key, modality.alias("modality"), F.concat(lead, body).alias("content"), "start_line", ends.alias("end_line"), "_k").where(not_blank(F.col("content")))
    order = W.partitionBy(key).orderBy("start_line")
    return out.withColumn("segment_no", (F.row_number().over(order) - 1).cast("int")).select(key, "segment_no", "modality", "content", "start_line", "end_line")


def seg_chunk_g1(segments: DataFrame, key: str = "document_id", size: int = 500, overlap: int = 200) -> DataFrame:
    """(key, segment_no, modality, chunk_index, content): tables, images and figures whole and unstripped, text and code in word windows."""
    columns = [key, "segment_no", "modality", "chunk_index", "content"]
    whole = segments.where(F.col("modality").isin(*ATOMIC)).withColumn("chunk_index", F.lit(0)).select(*columns)
    cut = chunk_word_g1(segments.where(~F.col("modality").isin(*ATOMIC)), [key, "segment_no", "modality"], "content", size, overlap).select(*columns)
    return whole.unionByName(cut)


def chunk_id_g1(index: Column, modality: Column) -> Column:
    """Not unique in a document; unique_chunk_id is."""
    return F.concat(F.lit("chunk_"), index.cast("string"), F.lit("_"), modality)


def unique_chunk_id(key: Column, segment: Column, index: Column, modality: Column) -> Column:
    return F.concat_ws("_", key.cast("string"), segment.cast("string"), index.cast("string"), modality)


def chunk_assign_meta_g1(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks with source_file, document_type and processing_status of their document; chunks without one keep nulls."""
    meta = documents.select("document_id", F.col("file_path").alias("source_file"), F.lower("document_type").alias("document_type"), F.coalesce("processing_status", F.lit("pending")).alias("processing_status")).groupBy("document_id").agg(*[F.min(c).alias(c) for c in ("source_file", "document_type", "processing_status")])
    return chunks.join(meta, "document_id", "left")


def chunk_document_g1(documents: DataFrame, key: str = "document_id", text: str = "content", size: int = 500, overlap: int = 200) -> DataFrame:
    """Segmentation and chunking in one: chunks of all modalities with both ids."""
    chunks = seg_chunk_g1(seg_lines_g1(documents, key, text), key, size, overlap)
    return chunks.withColumns({"chunk_id": chunk_id_g1(F.col("chunk_index"), F.col("modality")), "chunk_key": unique_chunk_id(F.col(key), F.col("segment_no"), F.col("chunk_index"), F.col("modality"))})
