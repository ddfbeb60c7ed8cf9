"""Results of an analysis: a JSON file with totals and counts by document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE = "array<struct<content_preview:string,metadata:struct<word_count:int,complexity_score:double,table_rows:int,has_header:boolean>>>"
ANALYSIS = f"total_tables int, total_figures int, total_text int, total_code int, figures_by_document map<string,int>, tables_by_document map<string,int>, images_by_document map<string,int>, sample_table_chunks {SAMPLE}, sample_figure_chunks {SAMPLE}"


def read_analysis(spark: SparkSession, path: str) -> DataFrame:
    """The file as one row of a fixed schema; keys that it lacks are null."""
    return spark.read.schema(ANALYSIS).option("multiLine", True).json(path)


def counts_by_document(analysis: DataFrame, kind: str) -> DataFrame:
    """(document_id, n) of figures, tables or images; no rows where the file has none."""
    return analysis.select(F.explode(f"{kind}_by_document").alias("document_id", "n"))


def samples(analysis: DataFrame, kind: str) -> DataFrame:
    """(content_preview, word_count, complexity_score, table_rows, has_header) of the sampled table or figure chunks."""
    return analysis.select(F.explode(f"sample_{kind}_chunks").alias("s")).select("s.content_preview", "s.metadata.*")
