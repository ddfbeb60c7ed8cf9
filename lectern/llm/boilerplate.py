"""Problem 6: lines that one source prints in many of its documents.

Lines are masked (numbers, dates, names); lines of one source with the same tokens and letters are one class. Classes are
clustered by locality-sensitive hashing of the five-word shingles of the masked line: a band ties its members to its
most frequent class, verified links are joined to components, and components that stand in many documents are the
source's boilerplate. One more band is that of a line's letters, whatever its masks, so lines equal but for these always
meet. Where near-duplicate lines are wanted too, an exact prefix filter finds the similar classes that the bands left apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import GOLDEN, U64, batches_of, gram_hashes, mix, passing, signed, string_hashes, table, written
from lectern.llm.components import components
from lectern.llm.spans import POWERS

# Month names that make a date.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
DATE = re.compile(rf"\b(?:\d{{1,2}}\.?[^\S\n]+)?(?:{MONTHS})[^\S\n]+\d{{1,4}}(?:,?[^\S\n]+\d{{4}})?\b|\b\d{{1,4}}[-/.]\d{{1,2}}[-/.]\d{{1,4}}\b", re.IGNORECASE)
NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
NAME = re.compile(r"(?<=[a-z,;] )[A-Z][a-z]+(?: [A-Z][a-z]+)*")
TOKEN = re.compile("[a-z]+|[#@~]")
TOKEN_OR_END = re.compile("[a-z]+|[#@~]|\n")
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 4, 2


def masked(line: str) -> list[str]:
    """The line's tokens with dates as @, numbers as # and names as ~."""
    return TOKEN.findall(NAME.sub("~", NUMBER.sub("#", DATE.sub("@", line))).lower())


def documents_sources(documents: DataFrame) -> DataFrame:
    """(document_id, source): the source of each document; the least one where repeated rows disagree."""
    return documents.select("document_id", F.col("metadata.source").alias("source")).where("document_id is not null and source is not null").groupBy("document_id").agg(F.min("source").alias("source"))


class Lines:
    """The lines of several texts: text and number (from 1) of each, its letters as a count and a hash, its masked tokens as symbols."""

    def __init__(self, texts: list[str]) -> None:
        blob = np.frombuffer("\n".join(texts).lower().encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.flatnonzero(blob == 10)
        letter = (blob >= 97) & (blob <= 122)
        at = np.concatenate([np.zeros(1, np.int64), np.cumsum(letter)])
        low, high = at[np.concatenate([[0], ends + 1])], at[np.concatenate([ends, [len(blob)]])]
        self.letters = high - low
        # a line's letters as a polynomial; the powers before it are divided out
        up, down = POWERS.get(int(at[-1]) + 1)
        total = np.concatenate([np.zeros(1, U64), np.cumsum(LETTERS[blob[letter] - 97] * up[: int(at[-1])], dtype=U64)])
        self.letters_key = mix((total[high] - total[low]) * down[low] + self.letters.astype(U64))
        count = np.array([t.count("\n") + 1 for t in texts])
        self.text = np.repeat(np.arange(len(texts)), count)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(count) - count, count) + 1

    def tokens(self, texts: list[str]) -> None:
        """symbols, and first and size of each line among them."""
        known: dict[str, int] = {"\n": 0}
        found = TOKEN_OR_END.findall("\n".join(NAME.sub("~", NUMBER.sub("#", DATE.sub("@", t))) for t in texts).lower())
        ids = np.fromiter((known.setdefault(t, len(known)) for t in found), np.int64, len(found))
        ends = np.flatnonzero(ids == 0)
        self.first = np.concatenate([[0], ends + 1])
        self.size = np.concatenate([ends, [len(ids)]]) - self.first
        self.symbols = string_hashes(list(known))[ids] if len(ids) else np.empty(0, U64)


LETTERS = mix(np.arange(1, 27, dtype=U64) * GOLDEN)


def text_lines(chunks: DataFrame, documents: DataFrame, least_letters: int) -> DataFrame:
    """(chunk_id, line_no, source_key, letters_key, unit, document_key, bands, line): the lines of text chunks that have letters enough.

    unit names the class of lines with the same source, letters and masked tokens.
    """
    text = chunks.where("modality = 'text' and chunk_id is not null and document_id is not null and content is not null").select("chunk_id", "document_id", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(2).to_pylist()
                lines = Lines(texts)
                keep = np.flatnonzero(lines.letters >= least_letters)
                if not len(keep):
                    continue
                lines.tokens(texts)
                source = string_hashes(part.column(3).to_pylist())[lines.text[keep]]
                document = string_hashes(part.column(1).to_pylist())[lines.text[keep]]
                own = mix(lines.letters_key[keep] ^ mix(source))
                g, grams, whole = line_grams(lines.symbols, lines.first[keep], lines.size[keep])
                unit = mix(own * GOLDEN + whole)
                bands = np.concatenate([*minima(g, grams, source), own + U64(BANDS)]).reshape(BANDS + 1, -1).T
                each = [x for t in texts for x in t.split("\n")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(lines.text[keep])), pa.array(lines.number[keep].astype(np.int32)), *(pa.array(signed(x)) for x in (source, own, unit, document)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(keep) * (BANDS + 1) + 1, BANDS + 1, dtype=np.int32)), pa.array(signed(np.ascontiguousarray(bands).ravel()))), pa.array([each[k] for k in keep.tolist()], pa.string())],
                    names=["chunk_id", "line_no", "source_key", "letters_key", "unit", "document_key", "bands", "line"],
                )

    return text.join(documents_sources(documents), "document_id").select("chunk_id", "document_id", "content", "source").mapInArrow(run, "chunk_id string, line_no int, source_key long, letters_key long, unit long, document_key long, bands array<long>, line string")


def line_grams(symbols: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of lines of tokens, their number for each line, and a hash of each whole line; a line under five tokens is one shingle."""
    padded = np.concatenate([symbols, np.zeros(SHINGLE, U64)])
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(symbols) * (up := POWERS.get(len(symbols) + 1))[0][: len(symbols)], dtype=U64)])
    whole = mix((total[first + size] - total[first]) * up[1][first] + size.astype(U64))
    grams = np.maximum(size - SHINGLE + 1, 1)
    begin = np.cumsum(grams) - grams
    at = np.arange(grams.sum()) - np.repeat(begin, grams) + np.repeat(first, grams)
    g = gram_hashes(padded, SHINGLE)[at]
    short = size < SHINGLE
    g[begin[short]] = whole[short]
    return g, grams, whole


def minima(g: np.ndarray, grams: np.ndarray, source: np.ndarray) -> Iterator[np.ndarray]:
    """A key of each line for each band of its signature."""
    first = np.cumsum(grams) - grams
    for b in range(BANDS):
        band = source + U64(b + 1)
        for r in range(ROWS):
            band = mix(band ^ np.minimum.reduceat(mix(g ^ U64(0xA5A5 + 7919 * (b * ROWS + r))), first))
        yield band


def line_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of masked lines, and the line of each."""
    tokens = [masked(x) for x in lines]
    size = np.array([len(t) for t in tokens])
    g, grams, _ = line_grams(token_symbols(tokens), np.cumsum(size) - size, size)
    return g, np.repeat(np.arange(len(lines)), grams)


def line_prefixes(classes: DataFrame) -> DataFrame:
    """(shingle, line_key, cluster, n, place): the least shingles of each class, so many that two classes with SIMILARITY share one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(batches, 4096):
            g, owner = line_shingles(part.column("line").to_pylist())
            g = mix(g ^ mix(part.column("source_key").to_numpy().view(U64))[owner])
            order = np.lexsort((g, owner))
            g, owner = g[order], owner[order]
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])])
            g, owner = g[new], owner[new]
            n = np.bincount(owner, minlength=part.num_rows)
            place = np.arange(len(g)) - (np.cumsum(n) - n)[owner]
            keep = place <= (n - np.ceil(n * SIMILARITY - 1e-9))[owner]
            g, owner, place = g[keep], owner[keep], place[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(g)), pa.array(part.column("line_key").to_numpy()[owner]), pa.array(part.column("cluster").to_numpy()[owner]), pa.array(n[owner].astype(np.int32)), pa.array(place.astype(np.int32))],
                names=["shingle", "line_key", "cluster", "n", "place"],
            )

    return classes.select("source_key", "line_key", "cluster", "line").mapInArrow(run, "shingle long, line_key long, cluster long, n int, place int")


def prefix_pairs(prefixes: DataFrame) -> DataFrame:
    """(line_key, head_key): classes of different clusters that share a shingle of their prefixes and may have SIMILARITY."""

    def pairs(key: np.ndarray, cluster: np.ndarray, n: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 20) // len(key))
        for at in range(0, len(key), step):
            i = slice(at, at + step)
            a, b = n[i, None], n[None, :]
            # where this shingle is the first that both have, no more than these can be common
            common = np.minimum(a - place[i, None], b - place[None, :])
            fits = (common * (1 + SIMILARITY) >= SIMILARITY * (a + b) - 1e-6) & (cluster[i, None] != cluster[None, :]) & (key[i, None] < key[None, :])
            x, y = np.nonzero(fits)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(key[at + x]), pa.array(key[y])], names=["line_key", "head_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in _and_end(batches):
            if batch is not None and batch.num_rows:
                kept.append(batch)
                shingle = batch.column(0).to_numpy()
                if shingle[0] == shingle[-1] == kept[0].column(0)[0].as_py():
                    continue  # the group may go on
            if not kept:
                continue
            t = pa.Table.from_batches(kept)
            columns = [t.column(k).to_numpy() for k in range(5)]
            new = np.flatnonzero(np.concatenate([[True], np.diff(columns[0]) != 0]))
            ends = np.concatenate([new[1:], [t.num_rows]])
            if batch is not None:  # the last group may go on
                kept = t.slice(int(new[-1])).combine_chunks().to_batches()
                new, ends = new[:-1], ends[:-1]
            for lo, hi in zip(new[ends - new > 1], ends[ends - new > 1]):
                if (columns[2][lo:hi] != columns[2][lo]).any():
                    yield from pairs(*(c[lo:hi] for c in columns[1:]))

    return prefixes.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(run, "line_key long, head_key long").distinct()


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def token_symbols(tokens: list[list[str]]) -> np.ndarray:
    known: dict[str, int] = {}
    ids = [known.setdefault(t, len(known)) for x in tokens for t in x]
    return string_hashes(list(known))[ids] if ids else np.empty(0, U64)


def shingles(line: str) -> set[tuple[str, ...]]:
    t = masked(line)
    return {tuple(t[i : i + SHINGLE]) for i in range(max(1, len(t) - SHINGLE + 1))}


def line_links(units: DataFrame) -> DataFrame:
    """(line_key, head_key): classes that are tied to the head of one of their bands: with the same letters, or with SIMILARITY.

    units: (unit, source_key, letters_key, bands, rows, line). Each band's most frequent class is its head.
    """
    each = units.select("unit", "letters_key", "rows", F.explode("bands").alias("band"))
    heads = each.groupBy("band").agg(F.count("*").alias("members"), F.max(F.struct("rows", "unit", "letters_key")).alias("head")).where("members > 1")
    heads = written(heads.select("band", F.col("head.unit").alias("head_key"), F.col("head.letters_key").alias("head_letters")), "band_heads")
    members = passing(each.select("band", "unit", "letters_key"), F.col("band"), heads.select("band"))
    pairs = members.join(heads, "band").where("unit <> head_key").select(F.col("unit").alias("line_key"), "letters_key", "head_key", "head_letters").distinct()
    pairs = written(pairs, "band_pairs")
    equal = pairs.where("letters_key = head_letters").select("line_key", "head_key")
    other = pairs.where("letters_key <> head_letters").select("line_key", "head_key")
    return equal.unionByName(near_lines(other, line_texts(other, units)))


def line_texts(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """(line_key, line) of the classes in pairs."""
    keys = pairs.select("line_key").union(pairs.select("head_key")).distinct()
    return passing(units.select(F.col("unit").alias("line_key"), "line"), F.col("line_key"), keys)


def line_clusters(units: DataFrame, complete: bool) -> DataFrame:
    """(unit, cluster): the class each class is clustered with; complete adds what the bands left apart."""
    links = written(line_links(units), "band_links")
    clusters = components(links.toDF("a", "b")).select(F.col("node").alias("unit"), F.col("component").alias("cluster"))
    if not complete:
        return clusters
    clusters = written(clusters, "band_clusters")
    apart = units.join(clusters, "unit", "left").select("source_key", F.col("unit").alias("line_key"), F.coalesce("cluster", "unit").alias("cluster"), "line")
    pairs = written(prefix_pairs(line_prefixes(apart)), "prefix_pairs")
    more = written(near_lines(pairs, line_texts(pairs, units)), "prefix_links")
    return components(links.unionByName(more).toDF("a", "b")).select(F.col("node").alias("unit"), F.col("component").alias("cluster"))


def near_lines(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """The pairs (line_key, head_key) whose shingles have SIMILARITY; text: (line_key, line)."""
    near = pairs.join(text, "line_key").join(text.toDF("head_key", "head_line"), "head_key").select("line_key", "line", "head_key", "head_line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            left, right = b.column(1).to_pylist(), b.column(3).to_pylist()
            sets = {x: shingles(x) for x in {*left, *right}}
            for k, (x, y) in enumerate(zip(left, right)):
                p, q = sets[x], sets[y]
                if len(p & q) >= SIMILARITY * len(p | q):
                    keep.append(k)
            yield b.select([0, 2]).take(pa.array(keep, pa.int64()))

    return near.mapInArrow(run, "line_key long, head_key long")


def boilerplate_lines(chunks: DataFrame, documents: DataFrame, least_docs: int = 6, least_letters: int = 30, complete: bool = True) -> DataFrame:
    """(chunk_id, line_no, docs, cluster_docs): the lines of text chunks that belong to a cluster standing in least_docs documents of their source.

    Rows of a chunk_id count once. Lines with fewer than least_letters letters, chunks with a null id, document or
    content, and documents without a source give nothing. docs is the number of the cluster's documents with the line's
    own letters, cluster_docs that of all its documents. Lines with the same letters are always in one cluster. With
    complete, clusters are the components of lines whose five-word shingles have a similarity of SIMILARITY or more,
    and none is missed; without it, they are what the bands tie.
    """
    lines = written(text_lines(chunks, documents, least_letters), "lines")
    units = lines.groupBy("unit").agg(F.count("*").alias("rows"), F.first("source_key").alias("source_key"), F.first("letters_key").alias("letters_key"), F.first("bands").alias("bands"), F.min("line").alias("line"))
    units = written(units, "units")
    clusters = written(line_clusters(units, complete), "line_clusters")
    # a cluster with fewer lines than least_docs can't stand in so many documents
    named = units.select("unit", "rows").join(clusters, "unit", "left").select("unit", "rows", F.coalesce("cluster", "unit").alias("cluster"))
    often = named.groupBy("cluster").agg(F.sum("rows").alias("n")).where(F.col("n") >= least_docs).select("cluster")
    kept = written(named.join(often, "cluster").select("unit", "cluster"), "frequent_units")
    rows = passing(lines.select("chunk_id", "line_no", "letters_key", "unit", "document_key"), F.col("unit"), kept.select("unit")).join(kept, "unit")
    rows = written(rows.select("chunk_id", "line_no", "cluster", "letters_key", "document_key").distinct(), "cluster_lines")
    own = rows.groupBy("cluster", "letters_key").agg(F.countDistinct("document_key").alias("docs"))
    whole = rows.groupBy("cluster").agg(F.countDistinct("document_key").alias("cluster_docs")).where(F.col("cluster_docs") >= least_docs)
    counted = own.join(whole, "cluster")
    return rows.select("chunk_id", "line_no", "cluster", "letters_key").join(counted, ["cluster", "letters_key"]).select("chunk_id", "line_no", "docs", "cluster_docs").distinct()


def without_boilerplate(chunks: DataFrame, documents: DataFrame, least_docs: int = 6, least_letters: int = 30) -> DataFrame:
    """(chunk_id, content, removed_lines): every text chunk once, without its source's boilerplate lines; null content stays null."""
    found = boilerplate_lines(chunks, documents, least_docs, least_letters).groupBy("chunk_id").agg(F.collect_set("line_no").alias("gone"))
    text = chunks.where("modality = 'text' and chunk_id is not null").groupBy("chunk_id").agg(F.max(F.struct(F.col("content").isNotNull(), "content")).alias("c")).select("chunk_id", "c.content")
    parts = F.filter(F.transform(F.split("content", "\n", -1), lambda line, i: F.when(~F.array_contains("gone", i + 1), line)), lambda line: line.isNotNull())
    return text.join(found, "chunk_id", "left").select("chunk_id", F.when(F.col("gone").isNull(), F.col("content")).otherwise(F.array_join(parts, "\n")).alias("content"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed_lines"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the clusters whose own letters stand in six of the cluster's documents; such lines meet in a band, so the prefix filter isn't needed."""
    found = boilerplate_lines(table(spark, sf_dir, "document_chunks"), table(spark, sf_dir, "processed_documents"), complete=False)
    return found.where("docs >= 6").select("chunk_id", "line_no")


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_boilerplate(table(spark, sf_dir, "document_chunks"), table(spark, sf_dir, "processed_documents"))


P6_SQL = r"""
with src as (select document_id, min(metadata.source) as source from processed_documents where metadata.source is not null group by 1),
c as (select distinct chunk_id, document_id, content from document_chunks where modality = 'text' and content is not null),
l as (select chunk_id, document_id, source, string_split(content, chr(10)) parts from c join src using (document_id)),
n as (select chunk_id, document_id, source, cast(unnest(generate_series(1, len(parts))) as integer) line_no, unnest(parts) line from l),
k as (select *, regexp_replace(lower(line), '[^a-z]', '', 'g') letters from n),
d as (select source, letters from k where length(letters) >= 30 group by all having count(distinct document_id) >= 6)
select distinct chunk_id, line_no from k join d using (source, letters)
"""
