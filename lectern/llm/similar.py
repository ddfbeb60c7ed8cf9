"""Problem 5: the most similar vectors of every vector.

An inverted file: every vector has one list, that of its nearest coarse centroid, and its residual there is kept as a
product-quantised code. Every vector is a query too and probes the lists whose centroids it is nearly as near to as to
its own; how nearly is measured on the sample, and no number of lists is fixed. A probed list is screened by asymmetric
distance tables, which need its codes only; what passes is reranked with exact cosines in double precision. Lists that lie
near each other form blocks, so that a query travels once for each block it probes. To other blocks than its own it travels
in 8 bits a number with the length of what that leaves out, by which every cosine there is known to lie between two bounds;
the pairs that may be among the k best by these bounds are few, and only their whole vectors are joined and compared. Equal
vectors are one class; of a class its least chunk_ids stand for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import one_each, passing, table, written
from lectern.llm.vectors import DIMENSION, MOST_FITTED, fit_sample, kmeans, kmeans_tree, matrix, one_vector, unit, usable

PER_LIST, MOST_LISTS = 400, 16_384
#: Vectors of the sample for each list, vectors in a block of lists as the sample lets expect, and queries that one task answers from a block.
SAMPLED, BLOCK, MOST_ASKED = 16, 8_192, 262_144
PARTS, CODES = 16, 256
#: Classes of several members that are known to every task; with more, they are met by a join.
MOST_SEVERAL = 1_000_000
#: Share of neighbours in the sample, and of made-up neighbours just similar enough, whose lists the margin must reach; a pair
#: can be met from either side, so nine in ten of the latter are. ASKED: queries this is measured on.
REACHED, REACHED_MADE, ASKED = 0.9995, 0.7, 2_048


class Codes:
    """Product quantiser of residuals: PARTS subspaces with CODES codewords each."""

    def __init__(self, residuals: np.ndarray) -> None:
        self.width = DIMENSION // PARTS
        self.books = [kmeans(np.ascontiguousarray(residuals[:, p * self.width : (p + 1) * self.width]), CODES, rounds=5, spherical=False) for p in range(PARTS)]

    def encode(self, residuals: np.ndarray) -> np.ndarray:
        out = np.empty((len(residuals), PARTS), np.uint8)
        for p, book in enumerate(self.books):
            part = residuals[:, p * self.width : (p + 1) * self.width]
            out[:, p] = (part @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
        return out

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, p]] for p, book in enumerate(self.books)], 1)

    def products(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """(codes, queries): each query's product with each coded residual, summed from the query's tables of products with all codewords."""
        total, part = np.zeros((len(codes), len(queries)), np.float32), np.empty((len(codes), len(queries)), np.float32)
        for p, book in enumerate(self.books):
            tables = book @ queries[:, p * self.width : (p + 1) * self.width].T
            np.take(tables, codes[:, p], axis=0, out=part, mode="clip")
            total += part
        return total


class Index:
    """Centroids, residual codes, the margin of what is probed, the slack of the codes, and the block of each list."""

    def __init__(self, sample: np.ndarray, rows: int, k: int, least: float) -> None:
        x = unit(sample).astype(np.float32)
        self.centroids = kmeans_tree(x, n_lists(rows))
        near, own = nearest(x, self.centroids)
        some = x[: 1 << 15]
        residual = some - self.centroids[near[: len(some)]]
        self.codes = Codes(residual)
        error = residual - self.codes.decode(self.codes.encode(residual))
        # the error of a product is that of the base vector seen along the query: queries are other vectors of the sample
        other = some[np.random.default_rng(3).permutation(len(some))]
        self.slack = float(np.quantile(np.abs(np.concatenate([(error * some).sum(1), (error * other).sum(1)])), 0.999))
        self.margin = self.measured(x, near, own, k, least)
        self.block = blocks_of(self.centroids, np.bincount(near, minlength=len(self.centroids)) * (rows / len(x)))

    def measured(self, x: np.ndarray, near: np.ndarray, own: np.ndarray, k: int, least: float) -> float:
        """How much less similar than its own centroid a query's neighbours' centroids are.

        Neighbours within the sample are further off than those among all vectors, so this reaches too far rather than
        too little. Where the sample holds few of them, made-up ones as far off as any that count speak for them.
        """
        rng = np.random.default_rng(5)
        asked = rng.permutation(len(x))[:ASKED]
        q, gap = x[asked], [np.empty(0, np.float32)]
        for at in range(0, len(q), 64):  # of the whole sample, a few queries at a time
            mine = asked[at : at + 64]
            s = x[mine] @ x.T
            s[np.arange(len(mine)), mine] = -2
            top = np.argpartition(s, max(0, len(x) - k - 1), axis=1)[:, -k:]
            row, col = np.nonzero(np.take_along_axis(s, top, 1) >= least)
            gap.append(own[mine[row]] - (x[mine[row]] * self.centroids[near[top[row, col]]]).sum(1))
        gap = np.concatenate(gap)
        across = rng.standard_normal(q.shape).astype(np.float32)
        across -= (across * q).sum(1, keepdims=True) * q
        made = least * q + np.sqrt(1 - least**2) * across / np.maximum(np.linalg.norm(across, axis=1, keepdims=True), 1e-12)
        made_gap = own[asked] - (q * self.centroids[nearest(made, self.centroids)[0]]).sum(1)
        return max(0.0, *(float(np.quantile(g, share)) for g, share in ((gap, REACHED), (made_gap, REACHED_MADE)) if len(g))) + 1e-4

    def placed(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, similarity to its centroid, codes) of each vector, and the (vector, block) that it probes as two rows."""
        x = unit(raw).astype(np.float32)
        s = x @ self.centroids.T
        near = s.argmax(1)
        best = s[np.arange(len(x)), near]
        row, which = np.nonzero(s >= best[:, None] - self.margin)
        visits = np.unique(row * (int(self.block.max()) + 1) + self.block[which])
        return near, best, self.codes.encode(x - self.centroids[near]), np.stack(np.divmod(visits, int(self.block.max()) + 1))


def n_lists(rows: int) -> int:
    return int(min(MOST_LISTS, max(1, rows // PER_LIST)))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near, own = np.empty(len(x), np.int64), np.empty(len(x), np.float32)
    for at in range(0, len(x), 2048):
        s = x[at : at + 2048] @ centroids.T
        near[at : at + 2048] = s.argmax(1)
        own[at : at + 2048] = s.max(1)
    return near, own


def blocks_of(centroids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The block of each list: lists in a chain of near ones, cut where BLOCK vectors are expected."""
    order, left = [0], np.ones(len(centroids), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, centroids @ centroids[order[-1]], -2).argmax()))
        left[order[-1]] = False
    block = np.empty(len(centroids), np.int64)
    at = filled = 0
    for k in order:
        if filled and filled + sizes[k] > BLOCK:
            at, filled = at + 1, 0
        block[k] = at
        filled += sizes[k]
    return block


class Base:
    """The vectors of a block, by list: what its queries are answered from."""

    def __init__(self, index: Index, rows: pa.Table) -> None:
        self.index = index
        lists = rows.column("list").to_numpy()
        order = np.argsort(lists, kind="stable")
        rows = rows.take(pa.array(order))
        self.exact, self.own = unit(matrix(rows.column("vec"))), rows.column("own").to_numpy()
        self.codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(-1, PARTS)
        self.key, self.name = rows.column("vec_key").to_numpy(), rows.column("chunk_id").combine_chunks()
        names = np.array(self.name.to_pylist())
        self.rank = np.argsort(np.argsort(names, kind="stable"), kind="stable")
        self.lists, self.first = np.unique(lists[order], return_index=True)
        self.end = np.append(self.first[1:], len(order))

    def probes(self, rows: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Whether the vectors in these rows probe the lists, row by row; where single precision leaves it open, they don't."""
        similar = np.einsum("ij,ij->i", self.exact[rows], self.index.centroids[lists])
        return similar >= self.own[rows] - self.index.margin + 1e-5

    def near(self, raw: np.ndarray, own: np.ndarray, keys: np.ndarray, k: int, least: float, error: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, base row, cosine) of the up to k best of each list a query probes; own: its similarity to its own centroid.

        error: raw are near the unit vectors of the queries, so far at most; cosines are as uncertain, and all that may be among the k best come.
        """
        ix = self.index
        exact, off = (unit(raw), np.zeros(len(raw))) if error is None else (raw, error)
        x = exact.astype(np.float32)
        s = x @ ix.centroids[self.lists].T
        probes = s >= (own - ix.margin - 1e-6 - off)[:, None]
        for j in np.flatnonzero(probes.any(0)).tolist():
            ask, lo, hi = np.flatnonzero(probes[:, j]), self.first[j], self.end[j]
            close = ix.codes.products(x[ask], self.codes[lo:hi]) + s[ask, j]
            least_close = (least - ix.slack - off[ask]).astype(np.float32)
            if hi - lo > k and np.count_nonzero(close >= least_close) > 4 * k * len(ask):
                # many are similar enough: one that may be among the k best is no further off than the k-th by twice the slack
                least_close = np.maximum(least_close, np.partition(close, hi - lo - k - 1, axis=0)[hi - lo - k - 1] - 2 * (ix.slack + off[ask]))
            b, q = np.nonzero(close >= least_close)
            b, q = b + lo, ask[q]
            other = self.key[b] != keys[q]
            b, q = b[other], q[other]
            cosine = np.empty(len(q))
            for at in range(0, len(q), 1 << 16):
                cosine[at : at + (1 << 16)] = np.einsum("ij,ij->i", exact[q[at : at + (1 << 16)]], self.exact[b[at : at + (1 << 16)]])
            ok = cosine >= least - 1e-12 - off[q]
            b, q, cosine = b[ok], q[ok], cosine[ok]
            if error is None:
                cosine = np.round(cosine, 6)
            order = np.lexsort((self.rank[b], -cosine, q))
            b, q, cosine = b[order], q[order], cosine[order]
            top = among_best(q, cosine, off[q], k)
            if top.any():
                yield q[top], b[top], cosine[top]


def among_best(q: np.ndarray, cosine: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """Which rows, sorted by query and falling cosine, are among the k best of their query or, by what they may be off, may be."""
    first = np.searchsorted(q, q)
    last = np.minimum(first + k - 1, len(q) - 1)
    worst = np.where(q[last] == q, cosine[last], -2.0) if len(q) else cosine
    return (np.arange(len(q)) - first < k) | (off > 0) & (cosine + 2 * off >= worst)


def class_neighbours(chunks: DataFrame, k: int, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members (chunk_id, vec_key), classes (vec_key, chunk_id, vec) and neighbours (vec_key, other_key, other_id, cosine): of each class of equal vectors its k most similar classes, and others that are similar enough."""
    spark = chunks.sparkSession
    rows = usable(chunks)
    members = written(one_vector(rows.select("chunk_id", "modality", "vec_key")).select("chunk_id", "vec_key"), "members")
    classes = written(rows.groupBy("vec_key").agg(F.min("chunk_id").alias("chunk_id"), F.first("vec").alias("vec")), "classes")
    n = classes.count()
    sample = fit_sample(classes, n, max(MOST_FITTED, SAMPLED * n_lists(n)))
    if not len(sample):
        return members, classes, spark.createDataFrame([], "vec_key long, other_key long, other_id string, cosine double")
    shared = spark.sparkContext.broadcast(Index(sample, n, k, least))  # MOST_LISTS centroids at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                near, best, codes, (row, block) = shared.value.placed(matrix(part.column("vec")))
                ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                visits = pa.ListArray.from_arrays(pa.array(ends), pa.array(block.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.astype(np.int32)), pa.array(best), pa.array([c.tobytes() for c in codes], pa.binary()), visits], names=[*part.schema.names, "list", "own", "code", "visits"])

    placed = written(classes.mapInArrow(place, "vec_key long, chunk_id string, vec binary, list int, own float, code binary, visits array<int>"), "placed")
    asked = dict(placed.select(F.explode("visits").alias("block")).groupBy("block").count().collect())  # a row for each block, MOST_LISTS at most
    found = answered(placed, shared, asked, k, least)
    # a pair that only one of the two can meet counts for the other
    back = found.where("mirrored").select(F.col("other_key").alias("vec_key"), F.col("vec_key").alias("other_key"), F.col("vec_id").alias("other_id"), "cosine", "error")
    each = found.drop("vec_id", "mirrored").unionByName(back).repartition("vec_key").groupBy("vec_key", "other_key")
    each = each.agg(F.min("other_id").alias("other_id"), F.max(F.col("cosine") - F.col("error")).alias("low"), F.min(F.col("cosine") + F.col("error")).alias("high"))
    mine = W.partitionBy("vec_key")
    ranked = each.withColumn("r", F.row_number().over(mine.orderBy(F.desc("low"), "other_id", "other_key"))).withColumn("worst", F.max(F.when(F.col("r") == k, F.col("low"))).over(mine))
    ranked = written(ranked.where((F.col("r") <= k) | F.col("other_id").isNull() & (F.coalesce("worst", F.lit(-2.0)) <= F.col("high"))).select("vec_key", "other_key", "other_id", F.col("low").alias("cosine")), "ranked")
    return members, classes, ranked.where("other_id is not null").unionByName(compared(ranked.where("other_id is null"), placed, least))


def compared(pairs: DataFrame, placed: DataFrame, least: float) -> DataFrame:
    """(vec_key, other_key, other_id, cosine) of pairs (vec_key, other_key), from either side, where they are similar enough."""
    pairs = written(pairs.select(F.least("vec_key", "other_key").alias("a"), F.greatest("vec_key", "other_key").alias("b")).distinct(), "pairs")
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    whole = written(passing(placed.select("vec_key", "chunk_id", "vec"), F.col("vec_key"), keys), "whole")
    a, b = (whole.select(*(F.col(c).alias(n) for c, n in (("vec_key", side), ("chunk_id", f"{side}_id"), ("vec", f"{side}_vec")))) for side in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.einsum("ij,ij->i", unit(matrix(batch.column("a_vec"))), unit(matrix(batch.column("b_vec")))) if batch.num_rows else np.empty(0)
            ok = pa.array(cosine >= least - 1e-12)
            cosine = pa.array(np.round(cosine, 6))
            for one, other in ("ab", "ba"):
                yield pa.RecordBatch.from_arrays([batch.column(one), batch.column(other), batch.column(f"{other}_id"), cosine], names=["vec_key", "other_key", "other_id", "cosine"]).filter(ok)

    return written(pairs.join(a, "a").join(b, "b").mapInArrow(run, "vec_key long, other_key long, other_id string, cosine double"), "compared")


def answered(placed: DataFrame, shared, asked: dict[int, int], k: int, least: float) -> DataFrame:
    """(vec_key, vec_id, other_key, other_id, cosine, error, mirrored): the best of each block that a vector probes; mirrored where the other doesn't probe the vector's list.

    error: how far the cosine may be off; 0 within a block. Only there mirrored pairs have vec_id and all have other_id.
    A block that many ask is copied, and its queries are shared out among the copies.
    """
    spark = placed.sparkSession
    many = {b: -(-n // MOST_ASKED) for b, n in asked.items()}
    places = iter(one_each(spark, tasks := max(1, sum(many.values()))).tolist())
    # each copy of a block is a task
    slots = spark.sparkContext.broadcast({b: [next(places) for _ in range(n)] for b, n in many.items()})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, where = shared.value.block, slots.value
        for batch in batches:
            key, mine, visits = batch.column("vec_key").to_numpy(), home[batch.column("list").to_numpy()], batch.column("visits").to_pylist()
            (row, slot, asks), (guest, to) = ([], [], []), ([], [])
            for i, (b, at) in enumerate(zip(mine.tolist(), visits)):
                for v in at:
                    own = where[v][int(key[i] % len(where[v]))]
                    if v != b:
                        guest.append(i), to.append(own)
                        continue
                    for c in where[v]:  # as one of the block's vectors it is in each copy
                        row.append(i), slot.append(c), asks.append(c == own)
            row, guest = np.array(row, np.int64), np.array(guest, np.int64)
            vec, own, lists = matrix(batch.column("vec")), batch.column("own").to_numpy(), batch.column("list").to_numpy()
            data = pa.concat_arrays([packed(vec[row], own[row], lists[row], np.array(asks, bool)), shortened(vec, own, lists, guest)])
            short = np.arange(len(row) + len(guest)) >= len(row)  # names and codes are for the base
            row = np.concatenate([row, guest])
            name, code = (batch.column(c).take(pa.array(row, mask=short)) for c in ("chunk_id", "code"))
            key = pa.array(np.array(slot + to, np.int32) << 1 | short.astype(np.int32))
            yield pa.RecordBatch.from_arrays([key, batch.column("vec_key").take(pa.array(row)), name, data, code], names=["key", "vec_key", "chunk_id", "data", "code"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, base = None, [], None

        def ask(t: pa.Table, error: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
            keys, lists, names = t.column("vec_key").to_numpy(), t.column("list").to_numpy(), t.column("chunk_id").combine_chunks()
            raw = matrix(t.column("vec")) if error is None else restored(t.column("vec"))
            met = list(base.near(raw, t.column("own").to_numpy(), keys, k, least, error))
            if not met:
                return
            q, b, cosine = (np.concatenate(c) for c in zip(*met))
            order = np.lexsort((base.rank[b], -cosine, q))
            q, b, cosine = q[order], b[order], cosine[order]
            off = np.zeros(len(q)) if error is None else error[q]
            mirrored = ~base.probes(b, lists[q])
            keep = among_best(q, cosine, off, k) | mirrored
            q, b, cosine, off, mirrored = q[keep], b[keep], cosine[keep], off[keep], mirrored[keep]
            other_id = base.name.take(pa.array(b, mask=off > 0))
            yield pa.RecordBatch.from_arrays([pa.array(keys[q]), names.take(pa.array(q, mask=~mirrored)), pa.array(base.key[b]), other_id, pa.array(cosine), pa.array(off), pa.array(mirrored)], names=["vec_key", "vec_id", "other_key", "other_id", "cosine", "error", "mirrored"])

        def settled() -> Iterator[pa.RecordBatch]:
            """The block's own vectors are all there: they become the base and ask first."""
            nonlocal base, kept
            rows = pa.concat_tables(kept)
            base, kept = Base(shared.value, rows), []
            mine = rows.filter(rows.column("asks"))
            for at in range(0, mine.num_rows, 1024):
                yield from ask(mine.slice(at, 1024))

        for batch in batches:
            code = batch.column("key").to_numpy()
            cuts = np.flatnonzero(np.diff(code)) + 1 if len(code) else []
            for lo, hi in zip([0, *cuts], [*cuts, len(code)]):
                if lo == hi:
                    continue
                which, role, part = int(code[lo]) >> 1, int(code[lo]) & 1, batch.slice(lo, hi - lo)
                if which != key:
                    if kept:
                        yield from settled()
                    key, base = which, None
                if role == 0:
                    columns = [part.column("vec_key"), part.column("chunk_id"), *unpacked(part.column("data")), part.column("code")]
                    kept.append(pa.Table.from_arrays(columns, names=["vec_key", "chunk_id", "vec", "own", "list", "asks", "code"]))
                    continue
                if kept:
                    yield from settled()
                if base is not None:  # else no vector is in the block
                    rows = np.frombuffer(b"".join(part.column("data").to_pylist()), SHORT)
                    columns = [part.column("vec_key"), part.column("chunk_id"), part.column("data"), *(pa.array(np.ascontiguousarray(rows[c])) for c in ("own", "list"))]
                    t, error = pa.Table.from_arrays(columns, names=["vec_key", "chunk_id", "vec", "own", "list"]), rows["error"].astype(np.float64)
                    for at in range(0, hi - lo, 1024):
                        yield from ask(t.slice(at, 1024), error[at : at + 1024])
        if kept:
            yield from settled()

    sent = "key int, vec_key long, chunk_id string, data binary, code binary"
    each = placed.mapInArrow(send, sent).repartition(tasks, F.shiftright("key", 1)).sortWithinPartitions("key")
    return written(each.mapInArrow(search, "vec_key long, vec_id string, other_key long, other_id string, cosine double, error double, mirrored boolean"), "neighbours")


#: A row's vector, its similarity to its own centroid, its list, and whether it asks in this task, in one field.
PACKED = np.dtype([("vec", np.float32, DIMENSION), ("own", np.float32), ("list", np.int32), ("asks", np.bool_)])


#: A visiting query: its unit vector in steps of `step`, the length of the rest (with room for rounding), and the same.
SHORT = np.dtype([("vec", np.int8, DIMENSION), ("step", np.float32), ("error", np.float32), ("own", np.float32), ("list", np.int32)])


def shortened(vec: np.ndarray, own: np.ndarray, lists: np.ndarray, at: np.ndarray) -> pa.Array:
    """The vectors in rows `at` as SHORT."""
    some, back = np.unique(at, return_inverse=True)
    x, rows = unit(vec[some]), np.empty(len(some), SHORT)
    rows["step"] = np.abs(x).max(1) / 127 if len(x) else 0
    step = rows["step"].astype(np.float64)[:, None]
    rows["vec"] = np.clip(np.rint(x / step), -127, 127)
    rows["error"] = np.linalg.norm(x - rows["vec"] * step, axis=1) + 2e-6
    rows["own"], rows["list"] = own[some], lists[some]
    return fields(rows[back])


def restored(data: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = np.frombuffer(b"".join(data.to_pylist()), SHORT)
    return rows["vec"] * rows["step"].astype(np.float64)[:, None]


def fields(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def packed(vec: np.ndarray, own: np.ndarray, lists: np.ndarray, asks: np.ndarray) -> pa.Array:
    rows = np.empty(len(vec), PACKED)
    rows["vec"], rows["own"], rows["list"], rows["asks"] = vec, own, lists, asks
    return fields(rows)


def unpacked(data: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    rows = np.frombuffer(b"".join(data.to_pylist()), PACKED)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * 4 * DIMENSION
    vec = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows["vec"]).tobytes())])
    return vec, pa.array(np.ascontiguousarray(rows["own"])), pa.array(np.ascontiguousarray(rows["list"])), pa.array(np.ascontiguousarray(rows["asks"]))


def most_similar(chunks: DataFrame, k: int = 10, least: float = 0.85) -> DataFrame:
    """(chunk_id, other_id, cosine, rank): for each chunk_id with a usable embedding its k most similar other chunks with a cosine of at least `least`.

    Cosines are rounded to 6 decimals, ties go to the smaller chunk_id. Rows of a chunk_id count once. The cosines are
    exact; of the neighbours a share of about one in a thousand can be missing (see the README). Null chunk_ids and embeddings that are null, empty, of another length, all zero or not finite give
    nothing. Other columns aren't read.
    """
    members, classes, near = class_neighbours(chunks, k, least)
    order = W.partitionBy("vec_key").orderBy("chunk_id")
    counted = members.groupBy("vec_key").agg(F.count("*").alias("n"), F.min("chunk_id").alias("first"))
    several = written(counted.join(classes.select("vec_key", "chunk_id"), "vec_key", "right").where("coalesce(n, 0) <> 1 or first <> chunk_id").select("vec_key"), "several")
    heads = members.join(several, "vec_key").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select("vec_key", F.col("chunk_id").alias("other_id"))
    own = heads.withColumn("cosine", F.lit(1.0))
    # a class with one member is that member; the others have more, or another name
    near = near.select("vec_key", "other_key", "other_id", "cosine")
    held = F.broadcast(several) if several.count() <= MOST_SEVERAL else several
    alone = near.join(held.withColumnRenamed("vec_key", "other_key"), "other_key", "left_anti").select("vec_key", "other_id", "cosine")
    more = near.drop("other_id").join(held.withColumnRenamed("vec_key", "other_key"), "other_key").join(heads.withColumnRenamed("vec_key", "other_key"), "other_key").select("vec_key", "other_id", "cosine")
    across = alone.unionByName(more)
    best = W.partitionBy("vec_key").orderBy(F.desc("cosine"), "other_id")
    # one more than k, since a chunk may be among the heads of its own class
    top = own.unionByName(across).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    top = top.groupBy("vec_key").agg(F.sort_array(F.collect_list(F.struct("r", "other_id", "cosine"))).alias("near"))
    each = members.join(top, "vec_key").select("chunk_id", F.filter("near", lambda x: x["other_id"] != F.col("chunk_id")).alias("near"))
    return each.select("chunk_id", F.posexplode(F.slice("near", 1, k)).alias("rank", "x")).select("chunk_id", "x.other_id", "x.cosine", (F.col("rank") + 1).alias("rank"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = most_similar(table(spark, sf_dir, "document_chunks"))
    return near.select(F.least("chunk_id", "other_id").alias("chunk_id_a"), F.greatest("chunk_id", "other_id").alias("chunk_id_b")).distinct()


def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_similar(table(spark, sf_dir, "document_chunks"))


P5_SQL = """
with u as (select distinct chunk_id, cast(embedding as double[]) e from document_chunks where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
v as (select chunk_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) e from u),
p as (select a.chunk_id a, b.chunk_id b, round(list_dot_product(a.e, b.e), 6) c from v a join v b on a.chunk_id <> b.chunk_id where list_dot_product(a.e, b.e) >= 0.85),
r as (select a, b, row_number() over (partition by a order by c desc, b) k from p)
select distinct least(a, b) as chunk_id_a, greatest(a, b) as chunk_id_b from r where k <= 10
"""
