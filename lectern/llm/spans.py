"""Problem 1: long exact spans shared between records.

Relative Lempel-Ziv parsing against reference blocks, arranged so that a text is parsed only against blocks that can
hold a factor of the least length. Every window of that length has an anchor, the least hash of its k-grams; stretches of
windows with one anchor form a segment. A reference block holds the distinct segments of one anchor, so equal windows
always meet in one block. Within a block equal windows are found by hash and joined to factors, runs along one source in
another document, which are compared character by character; factors are joined across block and factor boundaries.
Two cases rest on hashes alone: an anchor's only segment on a 64-bit key of its content, and blocks beyond a bound, which
go window by window, on two hashes of 64 bits. Texts travel once for each distinct segment, whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import GOLDEN, U64, codepoints, gram_hashes, mix, signed, table, written

GRAM = 64
#: Windows handled at once, and most distinct segments of an anchor, and characters of them, that one task compares as a block.
BLOCK, MOST_SEGMENTS, MOST_CHARS = 500_000, 5_000, 4_000_000
BASE = 0xD6E8FEB86659FD93
INVERSE = U64(pow(BASE, -1, 1 << 64))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window, by doubling."""
    done, level, out = 0, values, None
    step = 1
    n = len(values) - width + 1
    while width:
        if width & 1:
            part = level[done : done + n]
            out = part.copy() if out is None else np.minimum(out, part)
            done += step
        width >>= 1
        if width:
            level = np.minimum(level[:-step], level[step:])
            step *= 2
    return out


class Powers:
    """BASE and its inverse to the powers 0..n."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            self.up = np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, BASE, U64)]), dtype=U64)
            self.down = np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, INVERSE, U64)]), dtype=U64)
        return self.up, self.down


POWERS = Powers()


def pieces(texts: list[str | None], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(code points of several texts, text numbers, their starts there, offsets in the text): long texts are cut with an overlap of one window."""
    points, numbers, starts, offsets, size = [], [], [], [], 0
    for k, text in enumerate(texts):
        if text is None or len(text) < least:
            continue
        for at in range(0, len(text) - least + 1, BLOCK):
            part = codepoints(text[at : at + BLOCK + least - 1])
            points.append(part), numbers.append(k), starts.append(size), offsets.append(at)
            size += len(part)
            if size >= BLOCK:
                yield np.concatenate(points), np.array(numbers), np.array([*starts, size]), np.array(offsets)
                points, numbers, starts, offsets, size = [], [], [], [], 0
    if points:
        yield np.concatenate(points), np.array(numbers), np.array([*starts, size]), np.array(offsets)


def inside(starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows that lie in one piece, and each one's piece."""
    n = np.diff(starts) - least + 1
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[:-1], n), owner


def segments(texts: list[str | None], least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, anchor, content hash, first window, last window) of every segment."""
    for points, number, starts, offset in pieces(texts, least):
        symbols = mix(points.astype(U64) + GOLDEN)
        anchors = least_of(mix(gram_hashes(symbols, GRAM)), least - GRAM + 1)
        at, owner = inside(starts, least)
        value = anchors[at]
        new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]))
        end = np.concatenate([new[1:], [len(at)]]) - 1
        up, down = POWERS.get(len(points))
        total = np.concatenate([np.zeros(1, U64), np.cumsum(symbols * up[: len(points)], dtype=U64)])
        first, last = at[new], at[end]
        content = mix((total[last + least] - total[first]) * down[first] + (last - first).astype(U64))
        piece = owner[new]
        shift = offset[piece] - starts[:-1][piece]
        yield number[piece], value[new], content, first + shift, last + shift


def segment_rows(chunks: DataFrame, least: int) -> DataFrame:
    """(chunk_key, document_key, anchor, content_key, first, last) of each segment of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, document = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number, anchor, content, first, last in segments(batch.column(2).to_pylist(), least):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk[number]), pa.array(document[number]), pa.array(signed(anchor)), pa.array(signed(content)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    names=["chunk_key", "document_key", "anchor", "content_key", "first", "last"],
                )

    return keyed(chunks, least).mapInArrow(run, "chunk_key long, document_key long, anchor long, content_key long, first int, last int")


def keyed(chunks: DataFrame, least: int) -> DataFrame:
    rows = chunks.where("chunk_id is not null and document_id is not null").where(F.length("content") >= least)
    return rows.select(F.xxhash64("chunk_id").alias("chunk_key"), F.xxhash64("document_id").alias("document_key"), "content")


def factor(texts: list[str], low: np.ndarray, high: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Factors of every segment against all segments given: (segment, first window, last window) with another document.

    low and high are the least and the greatest document of a segment; where they differ, it is shared as it stands.
    """
    points = np.concatenate([codepoints(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    at, owner = inside(starts, least)
    hashes = gram_hashes(mix(points.astype(U64) + GOLDEN), least)[at]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    group = np.empty(len(at), np.int64)
    group[order] = np.repeat(np.arange(len(new)), np.diff(np.concatenate([new, [len(at)]])))
    a, b = low[owner], high[owner]
    least_doc, most_doc = np.minimum.reduceat(a[order], new), np.maximum.reduceat(b[order], new)
    # of each group one window of the least and one of the greatest document
    source_low, source_high = np.full(len(new), -1), np.full(len(new), -1)
    hit = a == least_doc[group]
    source_low[group[hit]] = np.flatnonzero(hit)
    hit = b == most_doc[group]
    source_high[group[hit]] = np.flatnonzero(hit)
    self_shared = a != b
    shared = self_shared | (least_doc[group] != most_doc[group])
    source = np.where(self_shared, np.arange(len(at)), np.where(a == least_doc[group], source_high[group], source_low[group]))
    step = at[source] - at
    index = np.flatnonzero(shared)
    if not len(index):
        return
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(index) != 1) | (owner[index][1:] != owner[index][:-1]) | (step[index][1:] != step[index][:-1]) | (owner[source[index]][1:] != owner[source[index]][:-1])]))
    ends = np.concatenate([cut[1:], [len(index)]]) - 1
    for i, j in zip(index[cut].tolist(), index[ends].tolist()):
        s, size = int(owner[i]), int(at[j] - at[i]) + least
        here, there = int(at[i]), int(at[source[i]])
        first = here - int(starts[s])
        if np.array_equal(points[here : here + size], points[there : there + size]):
            yield s, first, first + size - least
        else:  # hashes that collide: window by window, against every other segment
            for w in range(size - least + 1):
                text = texts[s][first + w : first + w + least]
                if any(text in texts[o] for o in range(len(texts)) if low[o] != low[s] or high[o] != high[s]):
                    yield s, first + w, first + w


def block_factors(distinct: DataFrame, least: int) -> DataFrame:
    """(anchor, content_key, from_window, to_window) by parsing each anchor's segments against each other; rows are distinct segments with texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            texts = rows.column("text").to_pylist()
            anchor, content = rows.column("anchor").to_numpy(), rows.column("content_key").to_numpy()
            low, high = rows.column("low").to_numpy(), rows.column("high").to_numpy()
            found = list(factor(texts, low, high, least))
            s, i, j = (np.array(x, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
            return pa.RecordBatch.from_arrays([pa.array(anchor[s]), pa.array(content[s]), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], names=["anchor", "content_key", "from_window", "to_window"])

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            size += batch.column("text").nbytes
            if size >= 4 * BLOCK:
                rows = pa.Table.from_batches(kept)
                anchors = rows.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))  # sorted: the last anchor may go on
                if cut:
                    for lo, hi in cuts(anchors[:cut], rows.column("text").to_pylist()[:cut]):
                        yield flush(rows.slice(lo, hi - lo))
                    rest = rows.slice(cut)
                    kept, size = rest.to_batches(), sum(b.column("text").nbytes for b in rest.to_batches())
        if kept:
            rows = pa.Table.from_batches(kept)
            for lo, hi in cuts(rows.column("anchor").to_numpy(), rows.column("text").to_pylist()):
                yield flush(rows.slice(lo, hi - lo))

    def cuts(anchors: np.ndarray, texts: list[str]) -> Iterator[tuple[int, int]]:
        total, begin, last = 0, 0, None
        for k, (a, t) in enumerate(zip(anchors.tolist(), texts)):
            if total >= BLOCK and a != last:
                yield begin, k
                begin, total = k, 0
            total, last = total + len(t), a
        if begin < len(texts):
            yield begin, len(texts)

    return distinct.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, content_key long, from_window int, to_window int")


def window_factors(distinct: DataFrame, least: int) -> DataFrame:
    """The same for anchors with very many distinct segments: every window is a row, so no task holds a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                symbols = mix(codepoints(text).astype(U64) + GOLDEN)
                h, g = gram_hashes(symbols, least), gram_hashes(mix(symbols), least)
                n = len(h)
                same = [pa.array(np.full(n, batch.column(c)[k].as_py(), np.int64)) for c in ("anchor", "content_key", "low", "high")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(signed(h)), pa.array(signed(g)), pa.array(np.arange(n, dtype=np.int32))], names=["anchor", "content_key", "low", "high", "h", "g", "w"])

    rows = distinct.mapInArrow(run, "anchor long, content_key long, low long, high long, h long, g long, w int")
    shared = rows.groupBy("h", "g").agg(F.min("low").alias("a"), F.max("high").alias("b")).where("a <> b").select("h", "g")
    return rows.join(shared, ["h", "g"]).select("anchor", "content_key", F.col("w").alias("from_window"), F.col("w").alias("to_window"))


def merged(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals (a, b) of each key with overlapping and touching ones taken together."""
    order = W.partitionBy(*keys).orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = intervals.withColumn("new", F.when(before >= F.col("a"), 0).otherwise(1))
    return marked.withColumn("k", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0))).groupBy(*keys, "k").agg(F.min("a").alias("span_start"), F.max("b").alias("span_end")).drop("k")


def shared_spans(chunks: DataFrame, least: int = 200, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(chunk_id, span_start, span_end): each longest stretch of a chunk's content made of runs of at least `least`
    characters that stand verbatim in a chunk of another document_id. Positions count code points from 0.

    Rows of one chunk_id count once; rows with null chunk_id, document_id or content, and short contents, give nothing;
    runs shared only within one document don't count. Other columns aren't read.
    """
    if least < GRAM:
        raise ValueError(f"spans have at least {GRAM} characters")
    rows = written(segment_rows(chunks, least), "segments")
    shared = rows.groupBy("anchor").agg(F.min("document_key").alias("a"), F.max("document_key").alias("b")).where("a <> b").select("anchor")
    met = written(rows.join(shared, "anchor"), "met_segments")
    classes = met.groupBy("anchor", "content_key").agg(F.min("document_key").alias("low"), F.max("document_key").alias("high"), F.min(F.struct("chunk_key", "document_key", "first", "last")).alias("at"))
    classes = written(classes, "segment_classes")
    chars = F.sum((F.col("at.last") - F.col("at.first") + least).cast("bigint"))
    kinds = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), chars.alias("chars")).where("kinds > 1").select("anchor", ((F.col("kinds") > most_segments) | (F.col("chars") > MOST_CHARS)).alias("large"))
    several = classes.join(kinds, "anchor").select("anchor", "content_key", "low", "high", "large", "at.*")
    wanted = several.groupBy("chunk_key", "document_key").agg(F.collect_list(F.struct("anchor", "content_key", "low", "high", "large", "first", "last")).alias("parts"))
    texts = keyed(chunks, least).join(wanted, ["chunk_key", "document_key"])
    part = texts.select("content", F.explode("parts").alias("p")).select("p.anchor", "p.content_key", "p.low", "p.high", "p.large", F.substring("content", F.col("p.first") + 1, F.col("p.last") - F.col("p.first") + least).alias("text")).where(F.length("text") >= least)
    part = written(part.dropDuplicates(["anchor", "content_key"]), "segment_texts")
    columns = ["anchor", "content_key", "low", "high", "text"]
    factors = block_factors(part.where("not large").select(*columns), least)
    if part.where("large").limit(1).count():
        factors = factors.unionByName(window_factors(part.where("large").select(*columns), least))
    partly = met.join(factors, ["anchor", "content_key"]).select("chunk_key", "document_key", (F.col("first") + F.col("from_window")).alias("a"), (F.col("first") + F.col("to_window") + least).alias("b"))
    # segments that are the only kind of their anchor stand as they are in several documents
    alone = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds = 1").select("anchor")
    wholly = met.join(alone, "anchor").select("chunk_key", "document_key", F.col("first").alias("a"), (F.col("last") + least).alias("b"))
    spans = merged(partly.unionByName(wholly), ["chunk_key", "document_key"])
    names = chunks.where("chunk_id is not null and document_id is not null").select("chunk_id", F.xxhash64("chunk_id").alias("chunk_key"), F.xxhash64("document_id").alias("document_key")).distinct()
    return spans.join(names, ["chunk_key", "document_key"]).select("chunk_id", "span_start", "span_end")


def shared_shares(chunks: DataFrame, least: int = 200) -> DataFrame:
    """(chunk_id, n_chars, shared_chars, spans, shared_share): every chunk with how much of it is shared elsewhere; null content counts as empty, its share is 0."""
    found = shared_spans(chunks, least).groupBy("chunk_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"), F.count("*").alias("spans"))
    sizes = chunks.where("chunk_id is not null").groupBy("chunk_id").agg(F.max(F.coalesce(F.length("content"), F.lit(0))).alias("n_chars"))
    both = sizes.join(found, "chunk_id", "left").na.fill(0, ["shared_chars", "spans"])
    return both.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "document_chunks"))


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_shares(table(spark, sf_dir, "document_chunks"))


P1_SQL = """
with c as (select distinct chunk_id, document_id, content from document_chunks where length(content) >= 200),
g as (select chunk_id, document_id, unnest(generate_series(1, length(content) - 199)) s, content from c),
h as (select chunk_id, document_id, s, md5(substr(content, s, 200)) k from g),
m as (select k from h group by k having min(document_id) <> max(document_id)),
p as (select chunk_id, s - 1 as a, s + 199 as b from h join m using (k)),
o as (select *, case when max(b) over (partition by chunk_id order by a rows between unbounded preceding and 1 preceding) >= a then 0 else 1 end as fresh from p),
i as (select *, sum(fresh) over (partition by chunk_id order by a rows unbounded preceding) as island from o)
select chunk_id, cast(min(a) as integer) as span_start, cast(max(b) as integer) as span_end from i group by chunk_id, island
"""

P1_SHARES_SQL = f"""
with found as (select chunk_id, cast(sum(span_end - span_start) as bigint) as shared_chars, count(*) as spans from ({P1_SQL}) s group by 1),
n as (select chunk_id, cast(max(coalesce(length(content), 0)) as integer) as n_chars from document_chunks group by 1)
select chunk_id, n_chars, coalesce(shared_chars, 0) as shared_chars, coalesce(spans, 0) as spans, case when n_chars > 0 then coalesce(shared_chars, 0)::double / n_chars else 0.0 end as shared_share from n left join found using (chunk_id)
"""
