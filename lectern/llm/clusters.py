"""Problem 3: clusters of mutually similar records.

Density clustering over spatially partitioned vectors: reduced vectors place each record in the cell of its nearest
centroid and, with a margin, in neighbouring cells. Each cell is clustered by itself: core records have several records
within the similarity, core records near each other and those on their border are a local cluster. Local clusters that
share a core record are one. Clusters are then checked on the full vectors: every two members must have the similarity. Medoids are
the members with the greatest mean similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import mix, partitions, signed, table, written
from lectern.llm.components import components
from lectern.llm.vectors import DIMENSION, Lists, fit_sample, groups_of, listed, matrix, n_lists, one_vector, unit, usable, without_hot

PER_CELL, MARGIN, MOST_MEMBERSHIPS, REDUCED = 600, 0.2, 3, 40
#: A core record has so many records within the similarity, itself counted, among those of its cell.
DENSITY = 3
#: Bytes of rows that one task shall read.
TASK_BYTES = 8 << 20
#: Cells with more members are split.
HOT_CELL = 16_384
#: Members of a cluster that one task compares; larger clusters are compared block by block.
MOST_TOGETHER = 8_192


class Sets:
    """Union-find over the rows of a cell; a set is named by its least row."""

    def __init__(self, n: int) -> None:
        self.name = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the sets of rows a and b, pair by pair."""
        a, b = self.name[a], self.name[b]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
        up: dict[int, int] = {}

        def top(k: int) -> int:
            while k in up:
                k = up[k]
            return k

        for x, y in pairs.tolist():
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        if up:
            to = np.arange(len(self.name))
            moved = list(up)
            to[moved] = [top(k) for k in moved]
            self.name = to[self.name]


def local_density(x: np.ndarray, copies: np.ndarray, least: float, density: int) -> tuple[np.ndarray, np.ndarray]:
    """(label, core) of each row of a cell: core rows have at least `density` records within the cosine, themselves and copies counted; core rows within it of each other share a label, other rows have the label of their nearest core row, or -1."""
    single, n = x.astype(np.float32), len(x)
    weight, tile = np.zeros(n), max(64, (1 << 21) // max(1, n))

    def near(at: int) -> np.ndarray:
        s = single[at : at + tile] @ single.T
        out = s >= least
        q, b = np.nonzero(np.abs(s - least) < 1e-5)
        if len(q):
            out[q, b] = np.einsum("ij,ij->i", x[at + q], x[b]) >= least - 1e-12
        out[np.arange(len(s)), at + np.arange(len(s))] = True
        return out

    for at in range(0, n, tile):
        weight[at : at + tile] = near(at) @ copies
    core = weight >= density
    sets = Sets(n)
    lone = np.flatnonzero(~core & (weight > copies))
    for at in range(0, n, tile):
        rows = np.arange(at, min(at + tile, n))
        if not core[rows].any():
            continue
        close = near(at) & core[None, :] & core[rows, None] & (sets.name[rows, None] != sets.name[None, :])
        q, b = np.nonzero(close)
        if len(q):
            sets.join(rows[q], b)
    label = np.where(core, sets.name, -1)
    for at in range(0, len(lone), tile):
        rows = lone[at : at + tile]
        s = np.where(core[None, :], x[rows] @ x.T, -2)
        best = s.argmax(1)
        ok = s[np.arange(len(rows)), best] >= least - 1e-12
        label[rows[ok]] = label[best[ok]]
    return label, core


def local_clusters(cells: DataFrame, least: float, density: int) -> DataFrame:
    """(vec_key, modality, local, core): of each cell its density clusters; local names cell and cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, ["modality", "list", "sub"]):
            label, core = local_density(unit(matrix(t.column("vec"))), t.column("copies").to_numpy().astype(float), least, density)
            keep = np.flatnonzero(label >= 0)
            key = t.column("vec_key").to_numpy().view(np.uint64)
            name = mix(key[label[keep]] + mix(np.array([t.column("list")[0].as_py() * 65536 + t.column("sub")[0].as_py()], np.uint64)))
            rows = pa.array(keep)
            yield pa.RecordBatch.from_arrays([t.column("vec_key").combine_chunks().take(rows), t.column("modality").combine_chunks().take(rows), pa.array(signed(name)), pa.array(core[keep])], names=["vec_key", "modality", "local", "core"])

    tasks = max(partitions(cells.sparkSession), cells.count() * 300 // TASK_BYTES)
    return cells.repartition(tasks, "modality", "list", "sub").sortWithinPartitions("modality", "list", "sub").mapInArrow(run, "vec_key long, modality string, local long, core boolean")


def without_far(rows: DataFrame, least: float) -> DataFrame:
    """rows (cluster, vec, n) of the clusters whose first and last vector have the cosine to every other: one far pair is enough to drop a cluster, whatever its size."""
    ends = rows.groupBy("cluster").agg(F.min("vec").alias("low"), F.max("vec").alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, low, high = (unit(matrix(batch.column(c))) for c in ("vec", "low", "high")) if batch.num_rows else (np.empty((0, DIMENSION)),) * 3
            far = np.minimum((x * low).sum(1), (x * high).sum(1)) < least - 1e-12
            yield pa.RecordBatch.from_arrays([batch.column("cluster").filter(pa.array(far))], names=["cluster"])

    far = rows.select("cluster", "vec").join(ends, "cluster").mapInArrow(run, "cluster long").distinct()
    return rows.join(far, "cluster", "left_anti")


def similar_throughout(rows: DataFrame, least: float) -> DataFrame:
    """(cluster): those of rows (cluster, vec, n) in which every two vectors have the cosine; n is the number of the cluster's rows."""
    small, large = rows.where(F.col("n") <= MOST_TOGETHER), rows.where(F.col("n") > MOST_TOGETHER)

    def least_cosine(a: np.ndarray, b: np.ndarray) -> float:
        return min(float((a[at : at + 512] @ b.T).min()) for at in range(0, len(a), 512))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, ["cluster"]):
            x = unit(matrix(t.column("vec")))
            if least_cosine(x, x) >= least - 1e-12:
                yield pa.RecordBatch.from_arrays([pa.array([t.column("cluster")[0].as_py()], pa.int64())], names=["cluster"])

    good = small.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(run, "cluster long")
    if not large.limit(1).count():
        return good

    # larger ones: members in blocks, each pair of blocks a task's group; a cluster fails with any of its block pairs
    blocks = F.ceil(F.col("n") / F.lit(MOST_TOGETHER // 2)).cast("int")
    spread = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
    each = spread.select("cluster", "vec", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select("cluster", "vec", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, ["cluster", "i", "j"]):
            block, i, j = t.column("block").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
            x = unit(matrix(t.column("vec")))
            a, b = x[block == i], x[block == j]
            worst = least_cosine(a, b) if len(a) and len(b) else 1.0
            yield pa.RecordBatch.from_arrays([pa.array([t.column("cluster")[0].as_py()], pa.int64()), pa.array([worst])], names=["cluster", "worst"])

    by = ["cluster", "i", "j"]
    worst = each.repartition(*by).sortWithinPartitions(*by).mapInArrow(pair, "cluster long, worst double")
    return good.unionByName(worst.groupBy("cluster").agg(F.min("worst").alias("worst")).where(F.col("worst") >= least - 1e-12).select("cluster"))


def clustered(chunks: DataFrame, least: float = 0.85, least_size: int = 5, density: int = DENSITY) -> tuple[DataFrame, DataFrame]:
    """members (chunk_id, modality, vec_key, cluster, cluster_id, size) and vectors (vec_key, modality, cluster, copies, vec)."""
    spark = chunks.sparkSession
    rows = usable(chunks).where("modality is not null")
    members = written(one_vector(rows.select("chunk_id", "modality", "vec_key")), "members")
    vectors = rows.groupBy("modality", "vec_key").agg(F.first("vec").alias("vec"))
    copies = members.groupBy("modality", "vec_key").agg(F.count("*").cast("int").alias("copies"))
    classes = written(vectors.join(copies, ["modality", "vec_key"]), "classes")
    n = classes.count()
    sample = fit_sample(classes, n)
    if not len(sample):
        empty = "vec_key long, modality string, cluster long, copies int, vec binary"
        return spark.createDataFrame([], "chunk_id string, modality string, vec_key long, cluster long, cluster_id string, size long"), spark.createDataFrame([], empty)
    cells = Lists(sample, n_lists(n, PER_CELL), MARGIN, MOST_MEMBERSHIPS, REDUCED)
    columns = ["vec_key", "modality", "copies"]
    members_of = without_hot(written(listed(classes, cells, columns), "cells"), columns, HOT_CELL)
    local = written(local_clusters(written(members_of, "cell_members"), least, density), "local_clusters")
    # a record in several local clusters that is a core record in one of them makes them one
    ties = local.groupBy("vec_key", "modality").agg(F.collect_set("local").alias("l"), F.max("core").alias("core")).where("size(l) > 1 and core").select(F.array_min("l").alias("a"), F.explode("l").alias("b"))
    names = written(components(ties), "cluster_names")
    of = local.groupBy("vec_key", "modality").agg(F.min("local").alias("node")).join(names, "node", "left").select("vec_key", "modality", F.coalesce("component", "node").alias("cluster"))
    of = written(of, "record_clusters")
    sizes = of.join(members, ["vec_key", "modality"]).groupBy("cluster").agg(F.count("*").alias("size"), F.min("chunk_id").alias("cluster_id"), F.countDistinct("vec_key").alias("n")).where(F.col("size") >= least_size)
    sizes = written(sizes, "cluster_sizes")
    in_clusters = classes.join(of.join(sizes, "cluster"), ["vec_key", "modality"]).select("vec_key", "modality", "cluster", "copies", "vec", "n")
    good = written(similar_throughout(written(without_far(in_clusters.select("cluster", "vec", "n"), least), "checked"), least), "clusters")
    out = of.join(good, "cluster").join(sizes.select("cluster", "cluster_id", "size"), "cluster").join(members, ["vec_key", "modality"])
    return out.select("chunk_id", "modality", "vec_key", "cluster", "cluster_id", "size"), in_clusters.join(good, "cluster").drop("n")


def similarity_clusters(chunks: DataFrame, least: float = 0.85, least_size: int = 5) -> DataFrame:
    """(chunk_id, cluster_id, modality, size): members of the sets of at least least_size chunks of one modality in which
    every two have the cosine and which no other chunk of the modality is that near to; cluster_id is the least chunk_id.

    Rows of a chunk_id count once. Null chunk_id or modality and unusable embeddings give nothing. Other columns aren't
    read. Cosines are exact; two members that share no cell and no chain of cells can be missed (see the README).
    """
    return clustered(chunks, least, least_size)[0].select("chunk_id", "cluster_id", "modality", "size")


def described(chunks: DataFrame, typical: int = 3, least: float = 0.85, least_size: int = 5) -> DataFrame:
    """(cluster_id, modality, size, medoids): each cluster with its most typical members, those of the greatest mean cosine to all; ties to the smaller chunk_id."""
    members, vectors = clustered(chunks, least, least_size)
    members, vectors = written(members, "members"), written(vectors, "vectors")
    fields = ", ".join(f"s{k} double" for k in range(DIMENSION))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            x = unit(matrix(batch.column("vec"))) * batch.column("copies").to_numpy()[:, None]
            names, at = np.unique(cluster, return_inverse=True)
            total = np.zeros((len(names), DIMENSION))
            np.add.at(total, at, x)
            yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array(total[:, k]) for k in range(DIMENSION))], names=["cluster", *(f"s{k}" for k in range(DIMENSION))])

    sums = vectors.select("cluster", "copies", "vec").mapInArrow(part, f"cluster long, {fields}").groupBy("cluster").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(DIMENSION)])
    sums = sums.select("cluster", F.array(*[F.col(f"s{k}") for k in range(DIMENSION)]).alias("total"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column("vec")))
            total = batch.column("total").flatten().to_numpy().reshape(-1, DIMENSION)
            yield pa.RecordBatch.from_arrays([batch.column("vec_key"), batch.column("modality"), pa.array(np.round((x * total).sum(1), 9))], names=["vec_key", "modality", "score"])

    scores = vectors.select("cluster", "vec_key", "modality", "vec").join(sums, "cluster").select("vec_key", "modality", "vec", "total").mapInArrow(score, "vec_key long, modality string, score double")
    order = W.partitionBy("cluster_id").orderBy(F.desc("score"), "chunk_id")
    best = members.join(scores, ["vec_key", "modality"]).withColumn("r", F.row_number().over(order)).where(F.col("r") <= typical)
    return best.groupBy("cluster_id", "modality", "size").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "chunk_id"))), lambda x: x["chunk_id"]).alias("medoids"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_clusters(table(spark, sf_dir, "document_chunks")).select("chunk_id", "cluster_id")


def p3_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(table(spark, sf_dir, "document_chunks"))


P3_SQL = """
with u as (select distinct chunk_id, modality, cast(embedding as double[]) e from document_chunks where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
v as (select chunk_id, modality, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) e from u),
p as (select a.chunk_id a, b.chunk_id b from v a join v b using (modality) where list_dot_product(a.e, b.e) >= 0.85),
n as (select a, list_sort(list(b)) near from p group by a),
c as (select near from n group by near having count(*) = len(near) and count(*) >= 5)
select a as chunk_id, near[1] as cluster_id from n join c using (near)
"""
