"""A vector collection on Parquet: versions in directories, partitioned by modality, one small file naming the current one.

A change writes a new version beside the old one and then moves the pointer, so readers never see half of it and nothing
that is being read is overwritten. Appends add a directory to the version's list, without rewriting what is there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.embedding import Hashing
from lectern.operators.search import search
from lectern.operators.statistics import count_by

SCHEMA = "id string, document string, document_id string, chunk_index int, chunk_type string, embedding_type string, length int, page_number int, embedding_model string, embedding_dimension int, metadata map<string,string>, embedding array<float>, modality string"
FIXED = ["document_id", "chunk_index", "chunk_type", "modality", "embedding_type", "length", "page_number", "embedding_model", "embedding_dimension"]


def store_metadata(chunks: DataFrame) -> DataFrame:
    """(id, document, the nine fixed keys, metadata, embedding): what is stored of chunks with content.

    metadata holds the fixed keys as strings, and of the chunk's own `extra` map the keys that aren't fixed. Missing
    values have defaults: unknown for kinds and the model, 0 for numbers.
    """
    have = set(chunks.columns)
    get = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in have else F.lit(default)
    inner = lambda f, default: F.coalesce(F.col("embedding_metadata")[f], F.lit(default)) if "embedding_metadata" in have else F.lit(default)
    values = {
        "document_id": get("document_id", "unknown"),
        "chunk_index": get("chunk_index", 0).cast("int"),
        "chunk_type": get("type", "unknown"),
        "modality": get("modality", "unknown") if "modality" in have else get("type", "unknown"),
        "embedding_type": inner("embedding_type", "unknown"),
        "length": F.length("content"),
        "page_number": get("page_number", 0).cast("int"),
        "embedding_model": inner("model", "unknown"),
        "embedding_dimension": inner("dimension", 0).cast("int"),
    }
    rows = chunks.where(F.length("content") > 0).select("content", *[v.alias(k) for k, v in values.items()], (F.col("extra") if "extra" in have else F.create_map().cast("map<string,string>")).alias("extra"), (F.col("embedding") if "embedding" in have else F.lit(None).cast("array<float>")).alias("embedding"))
    own = F.map_filter(F.coalesce("extra", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(FIXED))
    fixed = F.create_map(*[x for k in FIXED for x in (F.lit(k), F.col(k).cast("string"))])
    name = F.sha2(F.concat_ws("|", "document_id", "chunk_type", F.col("chunk_index").cast("string"), F.col("page_number").cast("string"), "content"), 256)
    return rows.select(name.alias("id"), F.col("content").alias("document"), *FIXED, F.map_concat(own, fixed).alias("metadata"), "embedding")


@dataclass
class Collection:
    """A named collection below a directory that all executors can reach."""

    spark: SparkSession
    root: str
    name: str = "documents"

    def __post_init__(self) -> None:
        self.path = f"{self.root.rstrip('/')}/{self.name}"
        self._jvm = self.spark._jvm
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not self.parts_known():
            self._point([])

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def parts_known(self) -> bool:
        return self._fs.exists(self._hadoop(f"{self.path}/current.json"))

    def parts(self) -> list[str]:
        stream = self._fs.open(self._hadoop(f"{self.path}/current.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _point(self, parts: list[str]) -> None:
        new = self._hadoop(f"{self.path}/current-{uuid.uuid4().hex}.json")
        stream = self._fs.create(new, True)
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()
        # one rename over the old pointer: readers find the old version or the new one
        hadoop = self._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(new.toUri() if new.isAbsolute() and new.toUri().getScheme() else self._fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(new, self._hadoop(f"{self.path}/current.json"), how)

    def read(self) -> DataFrame:
        return self._scan(self.parts()).drop("part")

    def _scan(self, parts: list[str]) -> DataFrame:
        """One scan of all parts, with the part of each row."""
        schema = f"{SCHEMA}, part string"
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*parts)

    def _write(self, rows: DataFrame, name: str | None = None) -> str:
        path = f"{self.path}/part={name or uuid.uuid4().hex}"
        rows.write.mode("overwrite").partitionBy("modality").parquet(path)
        return path

    def has(self, part: str) -> bool:
        """Whether a part of this name is stored."""
        return f"{self.path}/part={part}" in self.parts()

    def store(self, chunks: DataFrame, part: str | None = None) -> dict:
        """Appends chunks with content; returns their number and kinds. A second store of the same chunks stores them again.

        Under a name, a part is stored once: if it is there already, nothing is done; if an earlier attempt broke off
        before the part was pointed to, its files are replaced.
        """
        path = None
        if part is None or not self.has(part):
            path = self._write(store_metadata(chunks), part)
        added = self._scan([path or f"{self.path}/part={part}"])
        row = added.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("embedding_type")).alias("e"), F.array_sort(F.collect_set("chunk_type")).alias("c")).first()
        if row.n and path:
            self._point([*self.parts(), path])
        return {"stored_chunks": row.n, "collection_name": self.name, "embedding_types": row.e, "chunk_types": row.c}

    def clear(self) -> dict:
        self._point([])
        return {"success": True, "collection_name": self.name}

    def delete_document(self, document_id: str) -> int:
        """Deletes a document's rows by writing the others of the parts that hold them anew; returns how many there were."""
        parts = self.parts()
        held = self._scan(parts).where(F.col("document_id") == document_id).groupBy("part").count().collect()  # a row for each part
        touched = [p for p in parts if p.rpartition("=")[2] in {r["part"] for r in held}]
        if touched:
            rest = self._scan(touched).where(~F.col("document_id").eqNullSafe(document_id)).drop("part")
            self._point([*(p for p in parts if p not in touched), self._write(rest)])
        return sum(r["count"] for r in held)

    def search(self, vector: list[float], k: int = 10, where: Column | None = None, metric: str = "l2") -> DataFrame:
        return search(self.read(), vector, k, where, metric)

    def search_text(self, text: str, k: int = 10, where: Column | None = None, metric: str = "l2", embedder=None) -> DataFrame:
        """The k nearest rows to a text, embedded as the collection's rows are: by the built-in embedder unless another is given."""
        row = self.read().select("embedding_dimension").where("embedding_dimension > 0").first()
        vector = (embedder or Hashing(row[0] if row else 64))([text])[0]
        return self.search([float(x) for x in vector], k, where, metric)

    def stats(self) -> dict:
        rows = self.read()
        sample = rows.select("metadata").first()
        return {
            "collection_name": self.name,
            "total_chunks": rows.count(),
            "metadata_keys": sorted(sample.metadata) if sample else [],
            "chunk_type_distribution": dict(count_by(rows, "chunk_type", "k").collect()),
            "embedding_type_distribution": dict(count_by(rows, "embedding_type", "k").collect()),
        }

    def storage_stats(self) -> dict:
        """Bytes and number of the collection's files."""
        summary = self._fs.getContentSummary(self._hadoop(self.path))
        return {"total_size_bytes": summary.getLength(), "file_count": summary.getFileCount() + summary.getDirectoryCount() - 1}

    def export(self, path: str) -> dict:
        """Writes {id, document, metadata, embedding} as JSON lines, in parallel; returns the number."""
        rows = self.read()
        n = rows.count()
        if n:
            rows.select("id", "document", "metadata", "embedding").write.mode("overwrite").json(path)
        return {"collection_name": self.name, "exported_chunks": n}
