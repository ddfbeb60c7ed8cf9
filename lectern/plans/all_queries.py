"""All queries of the core; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.cleaning import clean_doc_g2
from lectern.operators.chunking import chunk_sentence_g2
from lectern.operators.statistics import chunk_summary
from lectern.plans import content_queries, statistics_queries, text_queries  # noqa: F401
from lectern.plans.registry import QUERIES, SQL, table


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("unknown")).alias("lang"), clean_doc_g2(F.col("text")).alias("text"))
    chunks = chunk_sentence_g2(docs, ["doc_id", "lang"], "text")
    return chunk_summary(chunks.withColumn("type", F.lit("text")), ["lang"]).orderBy("lang")


__all__ = ["QUERIES", "SQL", "flagship"]
