"""Problem 8: evaluation passages and questions inside training texts.

The n-grams of words of all evaluation parts are hashed into a set that is broadcast while it is small enough (checked);
every training text's windows of n words are held against it in one scan. A hit is verified word by word, so hash
collisions cost time only. The evaluation set's size is measured first; beyond a bound it is cut into slices, and the
training texts are scanned once for each slice. One slice's index is alive at a time, so the driver and the executors
hold no more than the bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import WORD, gram_hashes, mix, signed, string_hashes, table, written

#: Most bytes of evaluation text in one broadcast.
MOST_EVAL_BYTES = 64 << 20


def item_parts(items: DataFrame) -> DataFrame:
    """(item_id, part): the distinct texts in which an item can leak: its passage and its question, each by itself."""
    parts = items.select("item_id", F.explode(F.array("passage", "question")).alias("part"))
    return parts.where("item_id is not null and part is not null").distinct()


class Index:
    """Windows of n words of the evaluation parts, as sorted hashes with (part, offset)."""

    def __init__(self, rows: list[tuple[int, str]], n: int) -> None:
        by_part: dict[tuple[str, ...], list[int]] = {}
        for item, part in rows:
            found = WORD.findall(part.lower())
            if len(found) >= n:
                by_part.setdefault(tuple(found), []).append(item)
        self.n = n
        self.parts = list(by_part)
        self.items = [sorted(set(x)) for x in by_part.values()]
        self.word_ids: dict[str, int] = {}
        for p in self.parts:
            for w in p:
                self.word_ids.setdefault(w, len(self.word_ids) + 1)
        # symbols are hashes of words, so that the windows of a text need no ids of words outside the set
        words = list(self.word_ids)
        self.symbol = np.concatenate([np.zeros(1, np.uint64), mix(string_hashes(words) | np.uint64(1))]) if words else np.zeros(1, np.uint64)
        grams, where, offset = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k, p in enumerate(self.parts):
            g = gram_hashes(self.symbol[[self.word_ids[w] for w in p]], n)
            grams.append(g), where.append(np.full(len(g), k)), offset.append(np.arange(len(g)))
        g = np.concatenate(grams)
        order = np.argsort(g, kind="stable")
        self.grams, self.where, self.offset = g[order], np.concatenate(where)[order], np.concatenate(offset)[order]

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, int]]]:
        """The text's words, and (window start, part) of each window that stands in a part."""
        if not text or not len(self.grams):
            return [], []
        found = WORD.findall(text.lower())
        if len(found) < self.n:
            return found, []
        ids = np.fromiter(map(self.word_ids.get, found, _zeros), np.int64, len(found))
        known = ids > 0
        if np.count_nonzero(known) < self.n:
            return found, []
        # only windows of known words: the running count of known words grows by n over them
        total = np.concatenate([[0], np.cumsum(known)])
        starts = np.flatnonzero(total[self.n :] - total[: -self.n] == self.n)
        if not len(starts):
            return found, []
        g = gram_hashes(self.symbol[ids], self.n)[starts]
        low = np.searchsorted(self.grams, g, "left")
        inside = np.minimum(low, len(self.grams) - 1)
        out = []
        for s, at in zip(starts[self.grams[inside] == g].tolist(), low[self.grams[inside] == g].tolist()):
            window, gram = tuple(found[s : s + self.n]), self.grams[at]
            while at < len(self.grams) and self.grams[at] == gram:
                part, o = int(self.where[at]), int(self.offset[at])
                if self.parts[part][o : o + self.n] == window:
                    out.append((s, part))
                at += 1
        return found, out


class _Zeros:
    def __iter__(self):
        return self

    def __next__(self) -> int:
        return 0


_zeros = _Zeros()


def sliced(parts: DataFrame, most_bytes: int) -> tuple[int, DataFrame]:
    """Number of slices of a bounded size, and the parts with their slice. The whole size is measured first; normally there is one slice."""
    size = parts.agg(F.sum(F.length("part") * 4 + 64)).first()[0] or 0
    n = max(1, -(-size // most_bytes))
    return n, parts.withColumn("slice", F.pmod(F.xxhash64("part"), F.lit(n)))


def over_slices(documents: DataFrame, items: DataFrame, n: int, most_bytes: int, scan: Callable[[Broadcast], DataFrame]) -> DataFrame:
    """The union of scan(index) over the slices of items. One slice's index is alive at a time: with several, each result is written and the index released before the next is made."""
    spark = documents.sparkSession
    count, parts = sliced(item_parts(items), most_bytes)
    out = None
    for k in range(count):
        rows = [(r["item_id"], r["part"]) for r in parts.where(F.col("slice") == k).select("item_id", "part").collect()]  # most_bytes at most
        index = spark.sparkContext.broadcast(Index(rows, n))
        found = scan(index)
        if count > 1:
            found = written(found, f"slice_{k}")
            index.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def leaks(documents: DataFrame, items: DataFrame, n: int = 12, most_bytes: int = MOST_EVAL_BYTES) -> DataFrame:
    """(doc_id, item_id, span_start, span_end): each item's longest stretches of leaked words in a document, in word positions.

    A stretch is a union of overlapping windows of n words that stand in the item's passage or in its question.
    Null, empty and short texts on either side give nothing; rows of the same doc_id and text give the same rows once;
    a null doc_id or item_id is left out. Other columns aren't read. One scan of documents for each slice of items, no shuffle of texts.
    """
    source = documents.select(F.col("doc_id").cast("long"), F.col("text")).where("doc_id is not null and text is not null")

    def scan(index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for batch in batches:
                docs, its, starts, ends = [], [], [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    by_item: dict[int, list[int]] = {}
                    for s, part in ix.hits(text)[1]:
                        for item in ix.items[part]:
                            by_item.setdefault(item, []).append(s)
                    for item, at in by_item.items():
                        for a, b in stretches(sorted(set(at)), ix.n):
                            docs.append(doc), its.append(item), starts.append(a), ends.append(b)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(its, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["doc_id", "item_id", "span_start", "span_end"])

        return source.mapInArrow(run, "doc_id long, item_id long, span_start int, span_end int")

    return over_slices(documents, items, n, most_bytes, scan).distinct()


def stretches(starts: list[int], n: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + n)
        else:
            out.append((s, s + n))
    return out


def without_leaks(documents: DataFrame, items: DataFrame, n: int = 12, most_share: float = 0.5, most_bytes: int = MOST_EVAL_BYTES) -> DataFrame:
    """(doc_id, clean_text, removed_words, dropped): texts without the leaked stretches.

    A document of which more than most_share of the words leaked is dropped as a whole (clean_text null, dropped true);
    so is one whose spans leave nothing. Texts without leaks come out unchanged, null stays null; every row comes out once.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text"))
    if sliced(item_parts(items), most_bytes)[0] == 1:

        def scan(index: Broadcast) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield cleaned(batch.column(0), batch.column(1).to_pylist(), [[(s, s + n) for s, _ in index.value.hits(text)[1]] for text in batch.column(1).to_pylist()], most_share)

            return rows.mapInArrow(run, CLEANED)

        return over_slices(documents, items, n, most_bytes, scan)

    # several slices: their spans are found one slice after another and meet the texts by a join
    texts = rows.withColumn("key", F.xxhash64("text")).where("text is not null").select("key", "text").distinct()

    def spans(index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [index.value.hits(text)[1] for text in batch.column(1).to_pylist()]
                keys = pa.array(np.repeat(np.arange(len(hits)), [len(h) for h in hits]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keys), pa.array([s for h in hits for s, _ in h], pa.int32())], names=["key", "start"])

        return texts.mapInArrow(run, "key long, start int")

    found = over_slices(documents, items, n, most_bytes, spans).groupBy("key").agg(F.collect_set("start").alias("starts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield cleaned(batch.column(0), batch.column(1).to_pylist(), [[(s, s + n) for s in starts or []] for starts in batch.column(2).to_pylist()], most_share)

    return rows.withColumn("key", F.xxhash64("text")).join(found, "key", "left").select("doc_id", "text", "starts").mapInArrow(cut, CLEANED)


CLEANED = "doc_id long, clean_text string, removed_words int, dropped boolean"


def cleaned(ids: pa.Array, texts: list[str | None], spans: list[list[tuple[int, int]]], most_share: float) -> pa.RecordBatch:
    """Texts without the spans (of word positions), as rows of without_leaks."""
    out, removed, dropped = [], [], []
    for text, mine in zip(texts, spans):
        drop, count = False, 0
        if mine:
            spots = word_spots(text)
            gone = np.zeros(len(spots), bool)
            for a, b in mine:
                gone[a:b] = True
            count = int(gone.sum())
            drop = count > most_share * len(gone)
            text = None if drop else cut_words(text, spots, gone)
            drop |= not (text or "").strip()
        out.append(None if drop else text), removed.append(count), dropped.append(drop)
    return pa.RecordBatch.from_arrays([ids, pa.array(out, pa.string()), pa.array(removed, pa.int32()), pa.array(dropped)], names=["doc_id", "clean_text", "removed_words", "dropped"])


def word_spots(text: str) -> list[tuple[int, int]]:
    """Where the words of the lower-cased text stand in the text itself; a character may have several in lower case."""
    low = text.lower()
    spots = [m.span() for m in WORD.finditer(low)]
    if len(low) == len(text):
        return spots
    ends = np.cumsum([len(c.lower()) for c in text])
    return [(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b - 1, "right")) + 1) for a, b in spots]


def cut_words(text: str, spots: list[tuple[int, int]], gone: np.ndarray) -> str:
    """text without the runs of marked words; everything else stays as it is."""
    out, at, k = [], 0, 0
    while k < len(spots):
        if gone[k]:
            first = k
            while k + 1 < len(spots) and gone[k + 1]:
                k += 1
            out.append(text[at : spots[first][0]])
            at = spots[k][1]
        k += 1
    return "".join([*out, text[at:]])


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


P8_SQL = """
with d as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') w from documents where text is not null),
dg as (select doc_id, unnest(list_transform(generate_series(1, len(w) - 11), lambda i: array_to_string(w[i:i+11], ' '))) g from d where len(w) >= 12),
e as (select item_id, regexp_extract_all(lower(passage), '[a-z0-9]+') w from eval_items union all
      select item_id, regexp_extract_all(lower(question), '[a-z0-9]+') w from eval_items),
eg as (select item_id, unnest(list_transform(generate_series(1, len(w) - 11), lambda i: array_to_string(w[i:i+11], ' '))) g from e where len(w) >= 12)
select distinct doc_id, item_id from dg join eg using (g)
"""

P8_SPANS_SQL = """
with d as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') w from documents where text is not null),
dg as (select doc_id, i - 1 as s, array_to_string(w[i:i+11], ' ') g from (select doc_id, w, unnest(generate_series(1, len(w) - 11)) i from d where len(w) >= 12) x),
e as (select item_id, regexp_extract_all(lower(passage), '[a-z0-9]+') w from eval_items union all
      select item_id, regexp_extract_all(lower(question), '[a-z0-9]+') w from eval_items),
eg as (select item_id, unnest(list_transform(generate_series(1, len(w) - 11), lambda i: array_to_string(w[i:i+11], ' '))) g from e where len(w) >= 12),
m as (select distinct doc_id, item_id, s from dg join eg using (g)),
f as (select *, case when s <= lag(s) over (partition by doc_id, item_id order by s) + 12 then 0 else 1 end as fresh from m),
k as (select *, sum(fresh) over (partition by doc_id, item_id order by s rows unbounded preceding) as island from f)
select doc_id, item_id, cast(min(s) as integer) as span_start, cast(max(s) + 12 as integer) as span_end from k group by doc_id, item_id, island
"""
