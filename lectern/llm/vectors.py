"""Embeddings as tables: usable vectors, classes of equal ones, an inverted file of centroids with margins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import hashed_sample

DIMENSION = 64
#: Vectors that indexes are fitted on: those whose keys are least. Every vector is indexed.
MOST_FITTED = 32_768
MOST_LISTS = 2_048
#: Members of a hot list that each of its finer centroids is fitted on; margin and most memberships among these.
SAMPLED = 16
FINER = 0.03, 4


def usable(chunks: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """(chunk_id, modality, vec_key, vec): rows whose embedding has `dimension` finite numbers, not all zero; vec is their float32 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(sizes == dimension)
            if not len(rows):
                continue
            values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dimension)
            good = np.isfinite(values).all(1) & (values != 0).any(1)
            rows, values = pa.array(rows[good]), np.ascontiguousarray(values[good])
            data = [v.tobytes() for v in values]
            keys = np.fromiter((xxhash.xxh3_64_intdigest(d) for d in data), np.uint64, len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(keys.view(np.int64)), pa.array(data, pa.binary())], names=["chunk_id", "modality", "vec_key", "vec"])

    rows = chunks.where("chunk_id is not null and embedding is not null").select("chunk_id", "modality", "embedding")
    return rows.mapInArrow(run, "chunk_id string, modality string, vec_key long, vec binary")


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int = DIMENSION) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, dimension)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 8, spherical: bool = True, seed: int = 7) -> np.ndarray:
    """Centroids of rows x; the same for the same rows."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.empty(len(x), np.int64)
        half = 0.0 if spherical else 0.5 * (c * c).sum(1)
        for at in range(0, len(x), 4096):
            near[at : at + 4096] = (x[at : at + 4096] @ c.T - half).argmax(1)
        order = np.argsort(near, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(near[order]) != 0]))
        total = np.add.reduceat(x[order], new)
        used = near[order][new]
        c[used] = total / np.diff(np.concatenate([new, [len(x)]]))[:, None]
        empty = np.setdiff1d(np.arange(k), used)
        c[empty] = x[rng.choice(len(x), len(empty))]
        if spherical:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def kmeans_tree(x: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of unit rows; many of them by clusters of clusters, each with its share."""
    if k <= 1024:
        return kmeans(x, max(1, k))
    coarse = kmeans(x, int(k**0.5))
    near = np.concatenate([(x[at : at + 4096] @ coarse.T).argmax(1) for at in range(0, len(x), 4096)])
    size = np.bincount(near, minlength=len(coarse))
    return np.concatenate([kmeans(x[near == c], max(1, round(k * n / len(x)))) for c, n in enumerate(size) if n])


class Lists:
    """Inverted file: centroids of (possibly reduced) unit vectors; a vector belongs to its nearest list and to those within a margin."""

    def __init__(self, sample: np.ndarray, n_lists: int, margin: float, most: int, reduced: int | None = None) -> None:
        x = unit(sample).astype(np.float32)
        self.basis = None
        if reduced and len(x) > reduced:
            _, _, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
            self.basis = np.ascontiguousarray(v[:reduced].T)
            x = self.project(x)
        self.margin, self.most = margin, most
        self.centroids = kmeans(x, max(1, n_lists))

    @classmethod
    def of(cls, centroids: np.ndarray, margin: float, most: int) -> Lists:
        """Lists of centroids that are fitted already."""
        out = cls.__new__(cls)
        out.basis, out.margin, out.most, out.centroids = None, margin, most, centroids
        return out

    def project(self, x: np.ndarray) -> np.ndarray:
        if self.basis is None:
            return x
        y = x @ self.basis
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every membership of unit float32 rows x; the nearest list always, others within the margin of it."""
        s = self.project(x) @ self.centroids.T
        m = min(self.most, s.shape[1])
        top = np.argpartition(-s, m - 1, axis=1)[:, :m] if m < s.shape[1] else np.tile(np.arange(m), (len(s), 1))
        score = np.take_along_axis(s, top, 1)
        row, col = np.nonzero(score >= score.max(1, keepdims=True) - self.margin)
        return row, top[row, col]


def fit_sample(vectors: DataFrame, rows: int, most: int = MOST_FITTED) -> np.ndarray:
    """A bounded sample of distinct vectors out of `rows`, the same for the same data."""
    found = hashed_sample(vectors.select("vec_key", "vec"), F.col("vec_key"), most, rows).toArrow()
    if not found.num_rows:
        return np.empty((0, DIMENSION), np.float32)
    key = found.column("vec_key").to_numpy()
    return matrix(found.column("vec"))[np.concatenate([[True], key[1:] != key[:-1]])]


def groups_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of equal `by`, from batches sorted by it."""
    kept: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        columns = [t.column(c).to_pylist() for c in by]
        keys = list(zip(*columns))
        cuts = [0] + [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]] + [len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if kept and keys[lo] != last:
                yield pa.concat_tables(kept)
                kept = []
            kept.append(t.slice(lo, hi - lo))
            last = keys[lo]
    if kept:
        yield pa.concat_tables(kept)


def listed(classes: DataFrame, lists: Lists, columns: list[str]) -> DataFrame:
    """A row for each class and list it belongs to: columns, list, lists (their number), vec."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(lists)  # MOST_LISTS centroids at most
    fields = [classes.schema[c] for c in columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = unit(matrix(part.column("vec"))).astype(np.float32)
                row, which = index.assign(x)
                n = np.bincount(row, minlength=len(x))[row]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in columns), pa.array(which.astype(np.int32)), pa.array(n.astype(np.int32)), part.column("vec").take(take)], names=[*columns, "list", "lists", "vec"])

    return classes.select(*columns, "vec").mapInArrow(run, f"{schema}, list int, lists int, vec binary")


def without_hot(rows: DataFrame, columns: list[str], most: int) -> DataFrame:
    """Memberships with `sub`: lists of more than `most` members are split by finer centroids, with a margin as between lists; sub is 0 elsewhere.

    rows: columns, list, lists, vec.
    """
    hot = rows.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > most).collect()  # MOST_LISTS rows at most
    plain = rows.withColumn("sub", F.lit(0))
    if not hot:
        return plain
    names = [r["list"] for r in hot]
    large = rows.where(F.col("list").isin(names))
    parts = {r["list"]: int(max(2, min(256, r["n"] // 1024))) for r in hot}
    shared = rows.sparkSession.sparkContext.broadcast(finer_lists(large, parts))  # 256 centroids at most for each of MOST_LISTS
    names_out = [*columns, "list", "lists", "vec", "sub"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("list").to_numpy()
            if not len(lists):
                continue
            v = unit(matrix(batch.column("vec"))).astype(np.float32)
            for k in np.unique(lists):
                at = np.flatnonzero(lists == k)
                row, sub = shared.value[int(k)].assign(v[at])
                n = np.bincount(row, minlength=len(at))[row]
                take = pa.array(at[row])
                # such a vector has several memberships, whatever the number of its lists
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in [*columns, "list"]), pa.array(n.astype(np.int32) + 1), batch.column("vec").take(take), pa.array(sub.astype(np.int32))], names=names_out)

    split = large.select(*columns, "list", "lists", "vec").mapInArrow(run, f"{schema}, list int, lists int, vec binary, sub int")
    return plain.where(~F.col("list").isin(names)).select(*names_out).unionByName(split)


def finer_lists(large: DataFrame, parts: dict[int, int]) -> dict[int, Lists]:
    """Finer centroids of each hot list, `parts` of them, fitted in tasks on SAMPLED members for each; only the centroids come to the driver."""
    order = W.partitionBy("list").orderBy("vec_key")
    most = F.create_map(*[F.lit(x) for k, n in parts.items() for x in (int(k), SAMPLED * n)])
    sample = large.select("list", "vec_key", "vec").withColumn("k", F.row_number().over(order)).where(F.col("k") <= most[F.col("list")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, ["list"]):
            name = t.column("list")[0].as_py()
            c = Lists(matrix(t.column("vec")), parts[name], *FINER).centroids
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), pa.array([c.astype(np.float32).tobytes()], pa.binary())], names=["list", "centroids"])

    fitted = sample.select("list", "vec").repartition("list").sortWithinPartitions("list").mapInArrow(run, "list int, centroids binary")
    return {r["list"]: Lists.of(np.frombuffer(r["centroids"], np.float32).reshape(-1, DIMENSION), *FINER) for r in fitted.collect()}


def n_lists(n: int, per_list: int) -> int:
    return int(min(MOST_LISTS, max(1, n // per_list)))


def one_vector(rows: DataFrame) -> DataFrame:
    """(chunk_id, modality, vec_key): the vector of each chunk_id; the least key where repeated rows disagree."""
    return rows.groupBy("chunk_id").agg(F.min(F.struct("vec_key", "modality")).alias("x")).select("chunk_id", "x.modality", "x.vec_key")
