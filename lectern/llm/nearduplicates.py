"""Problem 4: near-duplicate records with small edits.

Meet-in-the-middle ball hashing over sets of word shingles. In each of several hash orders a record's fingerprint is its
LEAST_OF least shingles. Two fingerprints within a radius of 2 * DROPPED elements (each side lacks up to DROPPED of the
other's) meet in the middle: every fingerprint emits all variants with DROPPED elements left out, fingerprints are shuffled
on the variants, and pairs that collide are made distinct and verified on their whole sets. Records with equal sets are
one class, which emits its variants once. Variants with very many classes make no pairs; their classes go through an
exact prefix filter with the rarest shingles first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import U64, WORD, bloom, gram_hashes, mix, passing, signed, string_hashes, table, written
from lectern.llm.components import components

SHINGLE, SIMILARITY, LEAST_WORDS = 3, 0.6, 20
ORDERS, LEAST_OF, DROPPED = 10, 4, 1
#: Sets up to this size also meet on each of their shingles.
TINY = 5
#: Most classes of a variant that make pairs at once; beyond it the exact prefix filter takes over.
MOST_CLASSES = 100


class Sets:
    """Distinct shingles of several texts, sorted by text and hash."""

    def __init__(self, texts: list[str | None], shingle: int, least_words: int) -> None:
        known: dict[str, int] = {}
        ids: list[int] = []
        rows, sizes = [], []
        for k, text in enumerate(texts):
            found = WORD.findall(text.lower()) if text else []
            if len(found) >= max(least_words, shingle):
                ids += [known.setdefault(w, len(known)) for w in found]
                rows.append(k), sizes.append(len(found))
        self.rows, size = np.array(rows, np.int64), np.array(sizes, np.int64)
        if not rows:
            self.hashes, self.owner, self.size = np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
            return
        g = gram_hashes(mix(string_hashes(list(known)))[ids], shingle)
        start = np.cumsum(size) - size
        n = size - shingle + 1
        owner = np.repeat(np.arange(len(rows)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
        h = mix(g[at])
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        self.hashes, self.owner = h[new], owner[new]
        self.size = np.bincount(self.owner, minlength=len(rows))

    def set_keys(self) -> np.ndarray:
        total = np.zeros(len(self.rows), U64)
        if len(self.rows):
            total = np.add.reduceat(mix(self.hashes ^ U64(0x5851F42D4C957F2D)), np.cumsum(self.size) - self.size)
        return mix(total + self.size.astype(U64))

    def variants(self, orders: int, least_of: int, dropped: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, variant) of every text's fingerprints, by text."""
        n, keep = len(self.rows), least_of - dropped
        if not n:
            return np.empty(0, np.int64), np.empty(0, U64)
        first, none = np.cumsum(self.size) - self.size, np.iinfo(np.uint64).max
        keys, valid = [], []
        for t in range(orders):
            v = mix(self.hashes ^ U64(0x9E37 + 104729 * t))
            slots = []
            for _ in range(least_of):
                slots.append(np.minimum.reduceat(v, first))
                v[v == slots[-1][self.owner]] = none
            for chosen in combinations(range(least_of), keep):
                key = np.full(n, U64(len(chosen)))
                for k in chosen:
                    key = mix(key * U64(3) + slots[k])
                keys.append(key), valid.append(self.size > chosen[-1])
        keys, valid = np.stack(keys, 1), np.stack(valid, 1)
        text, key = np.repeat(np.arange(n), keys.shape[1])[valid.ravel()], keys.ravel()[valid.ravel()]
        tiny = self.size[self.owner] <= TINY
        if tiny.any():
            text, key = np.concatenate([text, self.owner[tiny]]), np.concatenate([key, mix(self.hashes[tiny] + U64(1))])
            order = np.argsort(text, kind="stable")
            text, key = text[order], key[order]
        return text, key


def fingerprints(chunks: DataFrame, shingle: int, least_words: int) -> DataFrame:
    """(chunk_id, document_id, set_key, n, variants) of every row with words enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                s = Sets(part.column(2).to_pylist(), shingle, least_words)
                if not len(s.rows):
                    continue
                text, variant = s.variants(ORDERS, LEAST_OF, DROPPED)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(s.rows)))]).astype(np.int32)
                rows = pa.array(s.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(signed(s.set_keys())), pa.array(s.size.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(variant)))],
                    names=["chunk_id", "document_id", "set_key", "n", "variants"],
                )

    rows = chunks.where("chunk_id is not null and document_id is not null and content is not null")
    return rows.select("chunk_id", "document_id", "content").mapInArrow(run, "chunk_id string, document_id string, set_key long, n int, variants array<long>")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (set_a, set_b) whose sets have the similarity, with it; texts: (set_key, content), one text of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                a, b = (Sets(part.column(c).to_pylist(), shingle, 0) for c in ("content_a", "content_b"))
                keep, share = [], []
                x, y = np.split(a.hashes, np.cumsum(a.size)[:-1]), np.split(b.hashes, np.cumsum(b.size)[:-1])
                for k in range(len(x)):
                    common = len(np.intersect1d(x[k], y[k], assume_unique=True))
                    s = common / (len(x[k]) + len(y[k]) - common)
                    if s >= similarity:
                        keep.append(k), share.append(s)
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(keep, pa.int64())) for c in ("set_a", "set_b")), pa.array(share, pa.float64())], names=["set_a", "set_b", "similarity"])

    left = texts.select(F.col("set_key").alias("set_a"), F.col("content").alias("content_a"))
    right = texts.select(F.col("set_key").alias("set_b"), F.col("content").alias("content_b"))
    return pairs.join(left, "set_a").join(right, "set_b").select("set_a", "set_b", "content_a", "content_b").mapInArrow(run, "set_a long, set_b long, similarity double")


def variants_met(classes: DataFrame, most_classes: int) -> tuple[DataFrame, DataFrame]:
    """pairs (set_a, set_b) of classes that share a variant, and hot (set_key): the classes of variants with more than most_classes of them.

    classes: (set_key, variants). Variants are counted with what each task can sum up first. Most stand in one class and
    go no further, and a variant of two classes is a pair by itself; only what passes the filter of the others is shuffled again.
    """
    each = classes.select("set_key", F.explode("variants").alias("variant"))
    met = each.groupBy("variant").agg(F.count("*").alias("n"), F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("n > 1")
    met = written(met, "met_variants")
    pairs = met.where("n = 2 and a < b").select(F.col("a").alias("set_a"), F.col("b").alias("set_b"))
    more = met.where("n > 2").select("variant", "n")
    many = more.count()
    if not many:
        return pairs.distinct(), classes.select("set_key").limit(0)
    filtered = classes.sparkSession.sparkContext.broadcast(bloom(more.select("variant"), many))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            variant = lists.flatten().to_numpy()
            keep = filtered.value.holds(variant)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[keep])), pa.array(variant[keep])], names=["set_key", "variant"])

    together = classes.select("set_key", "variants").mapInArrow(run, "set_key long, variant long").join(more, "variant")
    together = written(together, "variant_classes")
    groups = together.where(F.col("n") <= most_classes).groupBy("variant").agg(F.collect_set("set_key").alias("members"))
    within = groups.select(F.explode("members").alias("set_a"), "members").select("set_a", F.explode("members").alias("set_b")).where("set_a < set_b")
    return pairs.unionByName(within).distinct(), together.where(F.col("n") > most_classes).select("set_key").distinct()


def prefix_pairs(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs that may have the similarity, by the exact prefix filter: rarest shingles first, equal ones meet by a join.

    texts: (set_key, content). The join is a shuffle of (shingle, set) rows that Spark splits where it is skewed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = Sets(batch.column("content").to_pylist(), shingle, 0)
            keys = batch.column("set_key").to_numpy()[s.rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys[s.owner]), pa.array(s.size[s.owner].astype(np.int32)), pa.array(signed(s.hashes))], names=["set_key", "n", "shingle"])

    rows = written(texts.mapInArrow(run, "set_key long, n int, shingle long"), "hot_shingles")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    # shingles of one set only come first and meet nothing; how many there are follows from n
    shared = rows.join(counts, "shingle").groupBy("set_key", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
    length = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - 1e-9) + 1 - (F.col("n") - F.size("s"))
    prefix = shared.where(length > 0).select("set_key", "n", F.explode(F.slice("s", F.lit(1), length.cast("int"))).alias("p")).select("set_key", "n", "p.shingle")
    prefix = written(prefix, "prefixes")
    other = prefix.toDF("set_b", "n_b", "shingle")
    fits = F.least("n", "n_b") >= F.greatest("n", "n_b") * F.lit(similarity) - 1e-9
    return prefix.join(other, "shingle").where((F.col("set_key") < F.col("set_b")) & fits).select(F.col("set_key").alias("set_a"), "set_b").distinct()


def near_classes(chunks: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, most_classes: int = MOST_CLASSES) -> tuple[DataFrame, DataFrame]:
    """members (chunk_id, document_id, set_key, n) and links (set_a, set_b, similarity) between classes of equal sets."""
    sets = written(fingerprints(chunks, shingle, least_words), "fingerprints")
    members = sets.select("chunk_id", "document_id", "set_key", "n").distinct()
    # copies count once from here on: a class has the variants that each of its members has
    classes = written(sets.groupBy("set_key").agg(F.min("chunk_id").alias("chunk_id"), F.first("variants").alias("variants")), "classes")
    pairs, hot = variants_met(classes, most_classes)
    pairs, hot = written(pairs, "pairs"), written(hot, "hot_classes")
    heads = classes.select("set_key", "chunk_id")
    content = chunks.select("chunk_id", "content").where("chunk_id is not null and content is not null")
    if hot.limit(1).count():
        pairs = written(pairs.unionByName(prefix_pairs(class_texts(hot, heads, content, shingle, least_words), shingle, similarity)).distinct(), "pairs")
    wanted = pairs.select(F.col("set_a").alias("set_key")).union(pairs.select("set_b")).distinct()
    texts = written(class_texts(wanted, heads, content, shingle, least_words), "class_texts")
    return members, written(verified(pairs, texts, shingle, similarity), "links")


def class_texts(wanted: DataFrame, heads: DataFrame, content: DataFrame, shingle: int, least_words: int) -> DataFrame:
    """(set_key, content) of the wanted classes: a text of the head that has the class's set, should its rows differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = Sets(batch.column(1).to_pylist(), shingle, least_words)
            same = s.rows[signed(s.set_keys()) == batch.column(0).to_numpy()[s.rows]] if len(s.rows) else s.rows
            yield batch.take(pa.array(same, pa.int64()))

    named = written(wanted.join(heads, "set_key").select("set_key", "chunk_id"), "wanted_heads")
    texts = passing(content, F.xxhash64("chunk_id"), named.select(F.xxhash64("chunk_id").alias("key")))
    found = named.join(texts, "chunk_id").select("set_key", "content")
    return found.mapInArrow(run, "set_key long, content string").dropDuplicates(["set_key"])


def with_paths(members: DataFrame, documents: DataFrame) -> DataFrame:
    paths = documents.select("document_id", "file_path").where("document_id is not null and file_path is not null").groupBy("document_id").agg(F.min("file_path").alias("file_path"))
    return members.join(paths, "document_id").select("chunk_id", "set_key", "file_path").distinct()


def near_pairs(chunks: DataFrame, documents: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """(chunk_id_a, chunk_id_b, similarity): near-duplicate chunks of documents with different file_path, a < b.

    Rows of a chunk_id count once. Null chunk_id, document_id or content, contents under least_words words, and chunks
    whose document has no file_path give nothing. Other columns aren't read.
    """
    members, links = near_classes(chunks, shingle, similarity, least_words)
    rows = written(with_paths(members, documents), "members")
    a, b = rows.toDF("chunk_id_a", "set_a", "path_a"), rows.toDF("chunk_id_b", "set_b", "path_b")
    across = links.join(a, "set_a").join(b, "set_b").where("path_a <> path_b").select(F.least("chunk_id_a", "chunk_id_b").alias("chunk_id_a"), F.greatest("chunk_id_a", "chunk_id_b").alias("chunk_id_b"), "similarity")
    within = a.join(b, F.col("set_a") == F.col("set_b")).where("chunk_id_a < chunk_id_b and path_a <> path_b").select("chunk_id_a", "chunk_id_b", F.lit(1.0).alias("similarity"))
    return across.unionByName(within)


def near_groups(chunks: DataFrame, documents: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """(chunk_id, class_id, group_id, copies, links): one row for each chunk with words enough.

    class_id is the least chunk_id with the same set of shingles, group_id the least class_id connected with it by links,
    copies the number of chunks of the class and links the number of other classes it is near to. Pairs within a class
    are not made; file_path plays no part here.
    """
    members, links = near_classes(chunks, shingle, similarity, least_words)
    classes = written(members.groupBy("set_key").agg(F.min("chunk_id").alias("class_id"), F.countDistinct("chunk_id").alias("copies")), "classes")
    named = links.join(classes.select(F.col("set_key").alias("set_a"), F.col("class_id").alias("a")), "set_a").join(classes.select(F.col("set_key").alias("set_b"), F.col("class_id").alias("b")), "set_b").select("a", "b")
    named = written(named, "named_links")
    degree = named.select("a").union(named.select("b")).groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("links"))
    group = components(named).select(F.col("node").alias("class_id"), F.col("component").alias("group_id"))
    out = classes.join(degree, "class_id", "left").join(group, "class_id", "left").select("set_key", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return members.select("chunk_id", "set_key").distinct().join(out, "set_key").select("chunk_id", "class_id", "group_id", "copies", "links")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(table(spark, sf_dir, "document_chunks"), table(spark, sf_dir, "processed_documents")).select("chunk_id_a", "chunk_id_b")


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "document_chunks"), table(spark, sf_dir, "processed_documents"))


P4_SQL = """
with f as (select document_id, min(file_path) as file_path from processed_documents where file_path is not null group by 1),
c as (select distinct chunk_id, file_path, regexp_extract_all(lower(content), '[a-z0-9]+') w from document_chunks join f using (document_id) where content is not null),
s as (select chunk_id, file_path, unnest(list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i+2], ' ')))) g from c where len(w) >= 20),
n as (select chunk_id, count(*) n from s group by 1),
p as (select a.chunk_id as chunk_id_a, b.chunk_id as chunk_id_b, count(*) m from s a join s b on a.g = b.g and a.chunk_id < b.chunk_id and a.file_path <> b.file_path group by all)
select chunk_id_a, chunk_id_b from p join n x on x.chunk_id = chunk_id_a join n y on y.chunk_id = chunk_id_b where m >= 0.6 * (x.n + y.n - m) - 1e-9
"""
