"""Exact nearest neighbours and searches of a collection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Most bytes of query vectors that are broadcast; larger query sets are cut into slices.
MOST_QUERY_BYTES = 64 << 20


def squared_l2(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; null where a vector is all zero."""
    return F.lit(1.0) - dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


METRICS = {"l2": squared_l2, "cosine": cosine_distance}


def _near(metric: str, q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance): of each query the k nearest rows and all that tie with the last; exact distances."""
    if metric == "cosine":
        q, x = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (q, x))
        rough = 1 - q @ x.T
    else:
        rough = (q * q).sum(1)[:, None] - 2 * q @ x.T + (x * x).sum(1)
    last = np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
    slack = 1e-9 * (1 + np.abs(rough).max(1))  # what the products' rounding may shift
    a, b = np.nonzero(rough <= (last + slack)[:, None])
    exact = 1 - np.einsum("ij,ij->i", q[a], x[b]) if metric == "cosine" else ((q[a] - x[b]) ** 2).sum(1)
    return a, b, exact


def knn(queries: DataFrame, base: DataFrame, k: int = 10, metric: str = "l2", id: str = "id", vector: str = "embedding") -> DataFrame:
    """(query_id, id, distance, rank): the k nearest rows of base for each query; ties to the smaller id.

    queries and base hold (id, vector). The base is scanned once for each slice of queries whose size is bounded; each
    batch of it is reduced to a query's k best by matrix products before anything is shuffled. Null vectors, vectors of
    another length than the query's, of nulls and, for cosine, of zeros only give nothing.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    spark = base.sparkSession
    usable = lambda c: c.isNotNull() & ~F.exists(c, lambda x: x.isNull())
    q = queries.select(F.col(id).alias("query_id"), F.col(vector).cast("array<double>").alias("_q")).where(usable(F.col("_q")))
    size = q.agg(F.sum(F.size("_q") * 8 + 64)).first()[0] or 0
    n = max(1, -(-size // MOST_QUERY_BYTES))
    b = base.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("_v")).where(usable(F.col("_v")))
    kinds = [d.schema[id].dataType.simpleString() for d in (queries, base)]
    best = W.partitionBy("query_id").orderBy("distance", "id")
    out = None
    for part in range(n):
        rows = (q if n == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == part)).toArrow()  # bounded by MOST_QUERY_BYTES
        ids, vectors = rows.column("query_id").combine_chunks(), rows.column("_q").to_pylist()
        lengths = sorted({len(v) for v in vectors if v})
        groups = [(np.flatnonzero([len(v) == m for v in vectors]), np.array([v for v in vectors if len(v) == m], float)) for m in lengths]
        if metric == "cosine":
            groups = [(at[(m != 0).any(1)], m[(m != 0).any(1)]) for at, m in groups]
        shared = spark.sparkContext.broadcast((ids, groups))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            query_ids, all_groups = shared.value
            for batch in batches:
                lists = batch.column(1)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                for which, matrix in all_groups:
                    at = np.flatnonzero(sizes == matrix.shape[1]) if len(matrix) else np.empty(0, int)
                    if not len(at):
                        continue
                    x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                    if metric == "cosine":
                        keep = (x != 0).any(1)
                        at, x = at[keep], x[keep]
                    for lo in range(0, len(matrix), 1024) if len(at) else ():
                        a, r, d = _near(metric, matrix[lo : lo + 1024], x, k)
                        yield pa.RecordBatch.from_arrays([query_ids.take(pa.array(which[lo + a])), batch.column(0).take(pa.array(at[r])), pa.array(d)], names=["query_id", "id", "distance"])

        scored = b.mapInArrow(run, f"query_id {kinds[0]}, id {kinds[1]}, distance double")
        near = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out = near if out is None else out.unionByName(near)
    return out


def search(store: DataFrame, vector: list[float], k: int = 10, where: Column | None = None, metric: str = "l2") -> DataFrame:
    """(id, document, metadata, distance) of the k nearest rows to one vector among those that meet `where`; the filter reaches the scan."""
    rows = store if where is None else store.where(where)
    v = F.array(*[F.lit(float(x)) for x in vector])
    hit = rows.where(F.size("embedding") == len(vector)).select("id", "document", "metadata", METRICS[metric](F.col("embedding"), v).alias("distance"))
    return hit.where("distance is not null").orderBy("distance", "id").limit(k)
