"""What the operators of this subpackage share: tables, written stages, words and hashes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.plans.workdir import folder

#: A word is a longest run of these after lower-casing.
WORD = re.compile("[a-z0-9]+")
U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    path = f"{folder(df.sparkSession)}/lectern/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k symbols (uint64), by doubling; result has len(symbols) - k + 1 entries."""
    n = len(symbols)
    if n < k:
        return np.empty(0, U64)
    level, width, done, acc = symbols.astype(U64, copy=False), 1, 0, None
    base = GOLDEN | U64(1)
    rest = k
    while True:
        if rest & 1:
            if acc is None:
                acc = level[: n - width + 1].copy()
            else:
                m = n - done - width + 1
                acc = acc[:m] * base_pow(base, width) + level[done : done + m]
            done += width
        rest >>= 1
        if not rest:
            break
        m = n - 2 * width + 1
        level = level[:m] * base_pow(base, width) + level[width : width + m]
        width *= 2
    return acc


def base_pow(base: np.uint64, e: int) -> np.uint64:
    return U64(pow(int(base), e, 1 << 64))


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def string_hashes(values: list[str]) -> np.ndarray:
    """64-bit hashes of strings, the same in every process."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v.encode("utf-8", "surrogatepass")) for v in values), U64, len(values))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def batches_of(rows: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """Batches gathered to tables of at least n rows (the last may be smaller)."""
    kept, size = [], 0
    for b in rows:
        if b.num_rows:
            kept.append(b)
            size += b.num_rows
        if size >= n:
            yield pa.Table.from_batches(kept)
            kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)


def hashed_sample(df: DataFrame, hashed: F.Column, most: int, rows: int) -> DataFrame:
    """The `most` rows with the least hashes, of `rows` in all: rows far above the expected bound are left out before anything is sorted, so no task gets more than a few times `most`."""
    share = min(1.0, 2.0 * most / max(1, rows) + 100.0 / max(1, rows))
    df = df.withColumn("_hash", hashed)
    if share < 1:
        df = df.where(F.col("_hash") < -(1 << 63) + int(share * (1 << 64)))
    return df.orderBy("_hash", *[c for c in df.columns if c != "_hash"]).limit(most).drop("_hash")


def one_each(spark: SparkSession, n: int) -> np.ndarray:
    """n numbers that repartition(n, ...) by an int column sends to n different tasks, the k-th to task k."""
    found, most = np.full(n, -1), 4 * n
    while (found < 0).any():
        rows = spark.range(most).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("task")).toArrow()
        task = rows.column("task").to_numpy()
        found[task[::-1]] = np.arange(most)[::-1]
        most *= 4
    return found


class Bloom:
    """A set of 64-bit keys as bits: no key of the set is missed, few others pass. A key's bits lie in one of SEGMENTS segments, so each segment is made by one task."""

    SEGMENTS, HASHES = 64, 4

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits  # (SEGMENTS, bytes)

    @staticmethod
    def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Segment of each key, and its bits there; size: bits of a segment, a power of two."""
        h = mix(keys.view(U64) + GOLDEN)
        step = mix(h) | U64(1)
        return (keys.view(U64) % U64(Bloom.SEGMENTS)).astype(np.int64), [(h + U64(j) * step) % U64(size) for j in range(Bloom.HASHES)]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        segment, bits = self.places(keys, self.bits.shape[1] * 8)
        out = np.ones(len(keys), bool)
        for b in bits:
            out &= (self.bits[segment, b >> U64(3)] >> (b & U64(7)).astype(np.uint8)) & 1 == 1
        return out


def bloom(keys: DataFrame, n: int) -> Bloom:
    """The filter of keys (one long column) of which there are about n: 16 bits a key, 32 MB at most. Beyond that more keys pass; the joins behind it stay right."""
    size = 1 << min(22, max(12, int(np.ceil(np.log2(max(1, n) * 16 / Bloom.SEGMENTS)))))
    name = keys.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, bits = Bloom.places(batch.column(0).to_numpy(), size)
            for s in np.unique(segment).tolist():
                mine = made.setdefault(s, np.zeros(size // 8, np.uint8))
                for b in bits:
                    at = b[segment == s]
                    np.bitwise_or.at(mine, at >> U64(3), np.uint8(1) << (at & U64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), pa.array([m.tobytes() for m in made.values()], pa.binary())], names=["segment", "bits"])

    out = np.zeros((Bloom.SEGMENTS, size // 8), np.uint8)
    parts = keys.select(F.col(name).alias("key")).repartition(F.pmod("key", F.lit(Bloom.SEGMENTS))).mapInArrow(run, "segment int, bits binary")
    for r in parts.collect():  # SEGMENTS rows, 32 MB at most
        out[r["segment"]] |= np.frombuffer(r["bits"], np.uint8)
    return Bloom(out)


def passing(rows: DataFrame, key: F.Column, keys: DataFrame) -> DataFrame:
    """The rows whose key is among keys (one long column), and few others: what a join with keys would drop isn't shuffled for it."""
    filtered = rows.sparkSession.sparkContext.broadcast(bloom(keys, keys.count()))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = filtered.value.holds(batch.column(len(names)).to_numpy())
            yield batch.select(names).filter(pa.array(keep))

    return rows.withColumn("_key", key).mapInArrow(run, rows.schema)


def words(column) -> F.Column:
    """The words of a string column, on the JVM side."""
    return F.regexp_extract_all(F.lower(column), F.lit("[a-z0-9]+"), F.lit(0))
