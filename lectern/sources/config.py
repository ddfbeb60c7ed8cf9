"""The configuration: categories with the paths of their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.errors import ConfigurationError
from lectern.schemas import CONFIG, REQUIRED_SETTINGS


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The configuration file as one row of a fixed schema; a file that can't be read or parsed raises a ConfigurationError."""
    try:
        rows = spark.read.schema(CONFIG).option("multiLine", True).option("mode", "FAILFAST").json(path)
        rows.select("database_type", "categories").collect()
        return rows
    except Exception as e:
        raise ConfigurationError(f"{path}: {e}", {"path": path}) from e


def config_errors(config: DataFrame) -> DataFrame:
    """(category, setting): a row for each required setting that is null or empty."""
    bad = F.filter(F.array(*[F.when(F.coalesce(F.col(n), F.lit("")) == "", F.lit(n)) for n in REQUIRED_SETTINGS]), lambda x: x.isNotNull())
    return config.select(F.lit("configuration").alias("category"), F.explode(bad).alias("setting"))


def categories(config: DataFrame) -> DataFrame:
    """(category_name, num_questions, description, doc_paths) of a configuration."""
    c = config.select(F.explode("categories").alias("c"))
    return c.select(F.col("c.name").alias("category_name"), "c.num_questions", "c.description", "c.doc_paths")


def category_paths(rows: DataFrame) -> DataFrame:
    """(category_name, path, position): a row for each path of each category."""
    return rows.select("category_name", F.posexplode("doc_paths").alias("position", "path"))


def existing_paths(paths: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows whose path is in listing (path); null and empty paths and those that don't exist are left out."""
    there = listing.select("path").where("path is not null and path <> ''").distinct()
    return paths.join(there, "path", "left_semi")


def documents_from_categories(rows: DataFrame, listing: DataFrame, now: int) -> DataFrame:
    """(category_name, path, file_path, document_id, document_type, content, processing_status) of every path that exists.

    The id is made of the file's stem and `now`; content is a placeholder until the file is read.
    """
    p = existing_paths(category_paths(rows), listing)
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")
    return p.select(
        "category_name",
        "path",
        F.col("path").alias("file_path"),
        F.concat(F.lit("doc_"), stem, F.lit(f"_{now}")).alias("document_id"),
        F.lower(F.regexp_extract("path", r"\.([^./]*)\z", 1)).alias("document_type"),
        F.concat(F.lit("Document from "), "category_name", F.lit(" category")).alias("content"),
        F.lit("pending").alias("processing_status"),
    )
