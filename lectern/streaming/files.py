"""The pipeline over documents that keep coming: Parquet files of a folder, cleaned, chunked and stored batch by batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lectern.functions.cleaning import clean_doc_g2
from lectern.operators.chunking import chunk_sentence_g2
from lectern.operators.store import Collection
from lectern.plans.pipeline import Pipeline


def read_documents(spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def chunk_stream(documents: DataFrame, key: str = "document_id", text: str = "content", size: int = 1000, overlap: int = 200) -> DataFrame:
    """Cleaning and chunking are row by row, so the batch operators serve a stream as they are, without state."""
    return chunk_sentence_g2(documents.withColumn(text, clean_doc_g2(F.col(text))), key, text, size, overlap)


def windowed_counts(events: DataFrame, time: str = "ingested_at", late: str = "1 hour", window: str = "1 day", by: str = "source") -> DataFrame:
    """(start, by, n): rows in tumbling windows; rows later than the watermark are left out once their window is closed."""
    w = events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), F.coalesce(by, F.lit("unknown")).alias(by))
    return w.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


@dataclass
class Numbered:
    """A collection in which whatever is stored is one part with a name."""

    collection: Collection
    part: str

    def store(self, chunks: DataFrame) -> dict:
        return self.collection.store(chunks, self.part)


def store_stream(documents: DataFrame, pipeline: Pipeline, collection: Collection, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs the pipeline on each batch and appends to the collection. A batch that is done again is stored once: its part carries the batch's number."""

    def batch(df: DataFrame, number: int) -> None:
        if not collection.has(part := f"batch-{number}"):
            pipeline.run(df, collection=Numbered(collection, part))

    writer = documents.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
