"""Problem 2: text of scanned pages repaired into continuous paragraphs.

Scanned documents are told by words broken at line ends and by numbered page edges. Running heads and page numbers are
found at the edges of pages by what a document's edges have in common. Misread words go through a noisy channel: the
confusion probabilities are learned from proofread pages, the likelihood of words and word pairs is counted over all
documents that aren't scans, and each line's words are decoded by Viterbi over the candidates. Words broken at line ends
are joined, also over chunks and pages. Only chunks of modality text are read: no document with proofread pages has others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import GOLDEN, U64, bloom, hashed_sample, mix, partitions, signed, string_hashes, table, written

#: Proofread pages that confusions are learned from: those whose ids have the least hashes.
MOST_PROOFREAD = 300
#: Words and pairs that a task counts before it passes them on.
MOST_HELD = 1_000_000
#: A word is one that other documents have so often. Count of a word that was never seen, and of a pair before any is seen.
LEAST_SEEN, UNSEEN, PAIR_PRIOR = 3, 0.001, 0.05
# Marks that break a word, and misread character - meant character.
MARKS = "-­¬‐‑"
CONFUSIONS = [
    ("c", "e"), ("|", "i"), ("|", "l"), ("â", "a"), ("5", "s"), ("†", "t"), ("0", "o"), ("b", "h"), ("1", "l"), ("1", "i"), ("ii", "u"),
    ("cl", "d"), ("rn", "m"), ("l", "t"), ("l", "i"), ("q", "g"), ("m", "in"), ("m", "rn"), ("vv", "w"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("h", "li"), ("f", "e"), ("d", "cl"), ("8", "b"), ("6", "b"), ("9", "g"),
]
TOKEN = re.compile(r"(?:[^\W_]|[|†])+")
WORD = re.compile(r"[^\W\d_]+")
BROKEN = re.compile(rf"((?:[^\W_]|[|†])+)[{MARKS}]$")
STARTS = re.compile(r"(?:[^\W_]|[|†])+")
STARTS_MARKED = re.compile(r"(?:[^\W_]|[|†])+[.,;:?!)]*")
NUMBER = re.compile(r"^\W*(?:(?P<word>[^\W\d_]{1,5})(?:\.\s*|\s+|(?=\d)))?(?P<n>\d{1,5}|[ivxlc]{1,8}|[IVXLC]{1,8})(?:\s*(?:/|of)\s*\d{1,5})?\W*$")
BESIDE = re.compile(r"^\s*(?:(?P<a>\d{1,5}|[ivxlc]{1,8})\s{2,}(?P<t>\S.*?)|(?P<u>\S.*?)\s{2,}(?P<b>\d{1,5}|[ivxlc]{1,8}))\s*$")
SOFTER = [("ﬁ", "fi"), ("ﬂ", "fl"), ("rn", "m"), ("in", "m"), ("vv", "w"), ("cl", "d"), ("ii", "u"), ("li", "h")]
SAME = str.maketrans({"c": "e", "f": "e", "|": "l", "i": "l", "1": "l", "t": "l", "†": "l", "â": "a", "5": "s", "0": "o", "b": "h", "q": "g"})


def folded(text: str) -> str:
    """Letters of a text, the same for readings that the confusions make of one text."""
    t = text.lower()
    for a, b in SOFTER:
        t = t.replace(a, b)
    return re.sub(r"[^\w]|_", "", t.translate(SAME))


def roman(text: str) -> int | None:
    values = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    n = [values[c] for c in text.lower()]
    total = sum(-a if k + 1 < len(n) and a < n[k + 1] else a for k, a in enumerate(n))
    units = ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]
    tens = ["", "x", "xx", "xxx", "xl", "l", "lx", "lxx", "lxxx", "xc"]
    written_as = "c" * (total // 100) + tens[total // 10 % 10] + units[total % 10]
    return total if written_as == text.lower() else None


def printed(text: str) -> int | None:
    return int(text) if text.isdigit() else roman(text)


def page_number(line: str) -> int | None:
    """The number a line prints if it prints nothing else but the word page."""
    m = NUMBER.match(line.strip())
    if not m or (m["word"] and folded(m["word"]) not in (folded("page"), folded("p"), folded("pg"))):
        return None
    return printed(m["n"])


def title(line: str) -> bool:
    """True for a line in the style of a running head: few words, no sentence mark at its end, a capital first."""
    words = line.split()
    return bool(words) and len(words) <= 8 and len(line.strip()) <= 60 and line.strip()[-1] not in f".,;:?!{MARKS}" and line.strip()[0].isupper()


def scan_evidence(chunks: DataFrame) -> DataFrame:
    """(document_id, scanned) of each document with text: words broken at line ends, numbers at chunk edges, signs or digits within words; any of them often, or two of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line_end = re.compile(rf"[^\W\d_][{MARKS}]$", re.MULTILINE)
        within = re.compile("[a-z][|†015][a-z]")
        for batch in batches:
            breaks, numbers, odd, lines = [], [], [], []
            for text in batch.column(1).to_pylist():
                breaks.append(len(line_end.findall(text)))
                odd.append(len(within.findall(text)))
                kept = [x for x in text.split("\n") if x.strip()]
                edge = {0, len(kept) - 1} if kept else set()
                numbers.append(sum(page_number(kept[k]) is not None or (m := BESIDE.match(kept[k])) is not None and title(m["t"] or m["u"]) for k in edge))
                lines.append(len(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (breaks, numbers, odd, lines))], names=["document_id", "breaks", "numbers", "odd", "lines"])

    rows = chunks.select("document_id", "content").mapInArrow(run, "document_id string, breaks long, numbers long, odd long, lines long")
    found = rows.groupBy("document_id").agg(*[F.sum(c).alias(c) for c in ("breaks", "numbers", "odd", "lines")])
    often = lambda c, least, share: (F.col(c) >= least) & (F.col(c) >= share * F.col("lines"))
    kinds = sum((F.col(c) >= 1).cast("int") for c in ("breaks", "numbers", "odd"))
    return found.select("document_id", (often("breaks", 2, 0.01) | often("numbers", 2, 0.03) | often("odd", 1, 0.03) | (kinds >= 2)).alias("scanned"))


class Counts:
    """Words and pairs of neighbouring words of a task's texts, counted by number until they are taken."""

    def __init__(self) -> None:
        self.restart()

    def restart(self) -> None:
        self.ids: dict[str, int] = {}
        self.words, self.pairs, self.held = [], [], 0

    def add(self, texts: list[str]) -> None:
        ids, known = [], self.ids
        for text in texts:
            ids += [known.setdefault(w, len(known)) for w in WORD.findall(text.lower())]
            ids.append(-1)  # pairs don't reach over texts
        at = np.array(ids, np.int64)
        both = (at[:-1] >= 0) & (at[1:] >= 0)
        for kept, values in ((self.words, at[at >= 0]), (self.pairs, at[:-1][both] << 32 | at[1:][both])):
            kept.append(np.unique(values, return_counts=True))
            self.held += len(kept[-1][0])

    def take(self) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(words, counts, pair keys, counts); counting begins anew."""
        names = list(self.ids)
        hashes = mix(string_hashes(names)) if names else np.empty(0, U64)
        w, wn = summed(self.words)
        p, pn = summed(self.pairs)
        self.restart()
        return [names[k] for k in w.tolist()], wn, pair_keys(hashes[p >> 32], hashes[p & 0xFFFFFFFF]), pn


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([n for _, n in parts]), len(values)).astype(np.int64)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of pairs of words, from the words' mixed hashes."""
    return signed(mix(left * GOLDEN + right))


def sorted_out(chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """scanned chunks (distinct rows), (word, n) and (pair, n): words of all other documents, and pairs of neighbouring ones by key, with their counts.

    Texts are read once for this, whatever is asked of the counts afterwards; they are summed up in the tasks first.
    """
    text = chunks.where("modality = 'text' and chunk_id is not null and document_id is not null and content is not null").select("chunk_id", "document_id", "page_number", "chunk_index", "content")
    flags = written(scan_evidence(text), "scan_flags")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chunk_id", "document_id", "page_number", "chunk_index", "content", "word", "pair", "n"]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        counts = Counts()

        def flush() -> Iterator[pa.RecordBatch]:
            words, n, keys, m = counts.take()
            for word, pair, many in ((pa.array(words, pa.string()), pa.nulls(len(words), pa.int64()), n), (pa.nulls(len(keys), pa.string()), pa.array(keys), m)):
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(many), k) for k in kinds[:5]), word, pair, pa.array(many)], names=names)

        for batch in batches:
            scanned = batch.column(5).to_numpy(zero_copy_only=False)
            counts.add(batch.column(4).filter(pa.array(~scanned)).to_pylist())
            if counts.held > MOST_HELD:
                yield from flush()
            if scanned.any():
                kept = batch.filter(pa.array(scanned))
                yield pa.RecordBatch.from_arrays([*(kept.column(k) for k in range(5)), *(pa.nulls(kept.num_rows, k) for k in kinds[5:])], names=names)
        yield from flush()

    both = text.join(flags, "document_id").select("chunk_id", "document_id", "page_number", "chunk_index", "content", "scanned")
    both = written(both.mapInArrow(run, "chunk_id string, document_id string, page_number int, chunk_index int, content string, word string, pair long, n long"), "sorted_out")
    scans = both.where("chunk_id is not null").groupBy("chunk_id").agg(F.min(F.struct("document_id", F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"), "page_number", "content")).alias("c")).select("chunk_id", "c.*")
    words = both.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    pairs = both.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
    return written(scans, "scans"), written(words, "words"), pairs


def edge_lines(scans: DataFrame) -> DataFrame:
    """(document_id, chunk_id, line_no, page, place, title, key, number): the lines at the edges of pages that may be heads or numbers."""
    order = W.partitionBy("document_id").orderBy("chunk_index", "chunk_id")
    rows = scans.select("document_id", "chunk_id", "page_number", "content", F.lag("page_number").over(order).alias("before"), F.lead("page_number").over(order).alias("after"), F.lag("chunk_id").over(order).isNull().alias("first"), F.lead("chunk_id").over(order).isNull().alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for document, chunk, page, text, before, after, first, last in zip(*(batch.column(c).to_pylist() for c in range(8))):
                lines = [(n, x) for n, x in enumerate(text.split("\n"), 1) if x.strip()]
                if not lines:
                    continue
                top = first or page is None or before is None or before != page
                bottom = last or page is None or after is None or after != page
                guess = page if page is not None else before if before is not None else after
                places = {}
                if bottom:
                    places |= {n: "bottom" for n, _ in lines[-2:]}
                if top:
                    places |= {n: "top" for n, _ in lines[:2]}
                for k, (n, x) in enumerate(lines):
                    if n not in places:
                        continue
                    place = places[n]
                    near = k if place == "top" else len(lines) - 1 - k
                    number, beside = page_number(x), BESIDE.match(x)
                    text_part = None
                    if number is None and beside and title(beside["t"] or beside["u"]):
                        number, text_part = printed(beside["a"] or beside["b"]), beside["t"] or beside["u"]
                    elif number is None and title(x):
                        text_part = x
                    if number is None and text_part is None:
                        continue
                    style = None if text_part is None else "upper" if text_part.upper() == text_part else "name" if all(w[:1].isupper() or not w[:1].isalpha() for w in text_part.split()) else "first"
                    out.append((document, chunk, n, guess, place, near, style, None if text_part is None else folded(text_part), number, page is None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 10, [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.bool_()])], names=["document_id", "chunk_id", "line_no", "page", "place", "near", "style", "key", "number", "unsure"])

    return rows.mapInArrow(run, "document_id string, chunk_id string, line_no int, page int, place string, near int, style string, key string, number long, unsure boolean")


def page_marks(scans: DataFrame) -> DataFrame:
    """(chunk_id, line_no, header, page_number): the lines that are running heads or print their page's number."""
    edges = written(edge_lines(scans), "edges")
    # the number printed is the page's number and an offset that the document keeps
    numbered = edges.where("number is not null").withColumn("offset", F.col("number") - F.coalesce("page", F.lit(0)))
    counts = numbered.groupBy("document_id", "offset").agg(F.count("*").alias("n"), F.sum((F.col("near") == 0).cast("int")).alias("outer"))
    best = counts.groupBy("document_id").agg(F.max(F.struct("n", "outer", -F.abs("offset"), "offset")).alias("b")).select("document_id", F.col("b.offset").alias("best"))
    numbers = numbered.join(best, "document_id").where((F.col("offset") == F.col("best")) | (F.col("unsure") & F.col("page").isNotNull() & (F.abs(F.col("offset") - F.col("best")) <= 1)) | F.col("page").isNull())
    # heads: the same letters at several edges, or beside a page number, or the place and style of the document's heads
    named = edges.where("key is not null and key <> ''")
    kept = named.groupBy("document_id", "key", "place").agg(F.countDistinct("chunk_id").alias("n"), F.max(F.col("number").isNotNull()).alias("numbered"), F.max("style").alias("style"))
    sure = kept.where("n >= 2 or numbered")
    styles = sure.groupBy("document_id", "place", "style").agg(F.sum("n").alias("weight"))
    alone = named.join(sure.select("document_id", "key", "place"), ["document_id", "key", "place"], "left_anti").where("near = 0 or place = 'bottom'")
    like = alone.join(styles.select("document_id", "place", "style"), ["document_id", "place", "style"], "left_semi")
    # documents of one or two pages: an outermost line in head style next to a numbered edge
    few = alone.join(styles.select("document_id"), "document_id", "left_anti").join(numbers.select("document_id").distinct(), "document_id", "left_semi").where("style in ('upper', 'name') or place = 'bottom'")
    heads = named.join(sure.select("document_id", "key", "place"), ["document_id", "key", "place"], "left_semi").select("chunk_id", "line_no").unionByName(like.select("chunk_id", "line_no")).unionByName(few.select("chunk_id", "line_no"))
    both = heads.withColumn("h", F.lit(1)).withColumn("p", F.lit(0)).unionByName(numbers.select("chunk_id", "line_no").withColumn("h", F.lit(0)).withColumn("p", F.lit(1)))
    return both.groupBy("chunk_id", "line_no").agg((F.max("h") == 1).alias("header"), (F.max("p") == 1).alias("page_number"))


def body_lines(text: str, gone: set[int]) -> list[tuple[int, str]]:
    return [(n, x) for n, x in enumerate(text.split("\n"), 1) if n not in gone and x.strip()]


def linked(scans: DataFrame, marks: DataFrame) -> DataFrame:
    """scans with gone (lines that are marks), broken_before, and of the document's next chunk with any body: next_word (what it begins with), next_chunk and next_line.

    Chunks of blank lines and marks are passed over, however many there are.
    """
    gone = marks.groupBy("chunk_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    rows = scans.join(gone, "chunk_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, first, ends = [], [], []
            for text, gone in zip(batch.column("content").to_pylist(), batch.column("gone").to_pylist()):
                body = body_lines(text, set(gone))
                m = STARTS_MARKED.match(body[0][1].lstrip()) if body else None
                starts.append(m[0] if m else ""), first.append(body[0][0] if body else None)
                ends.append(bool(body and BROKEN.search(body[-1][1].rstrip())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(6)), pa.array(starts, pa.string()), pa.array(first, pa.int32()), pa.array(ends)], names=["chunk_id", "document_id", "chunk_index", "page_number", "content", "gone", "starts", "first", "ends"])

    out = rows.select("chunk_id", "document_id", "chunk_index", "page_number", "content", "gone").mapInArrow(run, "chunk_id string, document_id string, chunk_index int, page_number int, content string, gone array<int>, starts string, first int, ends boolean")
    # both windows grow row by row, so a document of any number of chunks takes one pass each
    so_far = lambda *order: W.partitionBy("document_id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    filled = lambda c: F.when(F.col("first").isNotNull(), c)
    following = F.last(filled(F.struct("starts", "chunk_id", "first")), ignorenulls=True).over(so_far(F.desc("chunk_index"), F.desc("chunk_id")))
    broken = F.last(filled(F.col("ends")), ignorenulls=True).over(so_far("chunk_index", "chunk_id"))
    out = out.withColumn("next", following).withColumn("broken_before", F.coalesce(broken, F.lit(False)))
    return out.select("chunk_id", "document_id", "chunk_index", "page_number", "content", "gone", "broken_before", F.col("next.starts").alias("next_word"), F.col("next.chunk_id").alias("next_chunk"), F.col("next.first").alias("next_line"))


def goes_on(word: str | None) -> bool:
    return bool(word) and (word[0].islower() or word[0] in "|†0158")


def line_words(text: str, gone: list[int], next_word: str | None, broken_before: bool) -> Iterator[tuple[int, list[tuple[str, int, int]], bool]]:
    """(line_no, words, hyphen) of every line; words are (word, length of the part on this line, line of the rest or 0).

    A broken word belongs to the line where it begins, whole; the rest on the next line is left out there.
    """
    lines = text.split("\n")
    skip = set(gone)
    body = [n for n, _ in body_lines(text, skip)]
    after = dict(zip(body, body[1:]))
    continued = broken_before and bool(body) and goes_on((m := STARTS.match(lines[body[0] - 1].lstrip())) and m[0])
    for n, line in enumerate(lines, 1):
        words = [(w, len(w), 0) for w in TOKEN.findall(line)]
        if n in skip or n not in after and (not body or n != body[-1]):
            yield n, words, False
            continue
        if continued:
            words = words[1:]
        continued, hyphen = False, False
        m = BROKEN.search(line.rstrip())
        if m and words:
            if n in after:
                s = STARTS.match(lines[after[n] - 1].lstrip())
                rest, where = (s[0] if s else None), after[n]
            else:
                s = STARTS.match(next_word or "")
                rest, where = (s[0] if s else None), -1
            if goes_on(rest):
                hyphen = True
                continued = where > 0
                words[-1] = (words[-1][0] + rest, len(words[-1][0]), where)
        yield n, words, hyphen


class Channel:
    """Probabilities of misreadings: (misread, meant) pairs with the share of the meant characters that are read so."""

    def __init__(self, counts: Counter[tuple[str, str]], meant: Counter[str]) -> None:
        prior = {c: 0.5 for c in CONFUSIONS}
        pairs = {k: counts.get(k, 0) + prior.get(k, 0) for k in {*prior, *(k for k, n in counts.items() if n >= 3)}}
        self.cost = {k: log(v / (meant[k[1]] + 500)) for k, v in pairs.items()}
        self.least = min(self.cost.values())

    def meanings(self, word: str) -> dict[str, float]:
        """Words that may have been meant, with the log probability of the misreading: one confusion; if far from any word, the caller asks for two."""
        out: dict[str, float] = {}
        for (bad, good), cost in self.cost.items():
            at = word.find(bad)
            while at >= 0:
                other = word[:at] + good + word[at + len(bad) :]
                out[other] = max(out.get(other, -1e9), cost)
                at = word.find(bad, at + 1)
        return out

    def meanings_twice(self, word: str) -> dict[str, float]:
        out: dict[str, float] = {}
        for first, cost in self.meanings(word).items():
            for second, more in self.meanings(first).items():
                if second != word:
                    out[second] = max(out.get(second, -1e9), cost + more)
        return out


def learned(scans: DataFrame, proofread: DataFrame, most: int = MOST_PROOFREAD) -> Channel:
    """Confusions of a bounded sample of proofread pages, by aligning their words with what the scan has."""
    pages = proofread.where("document_id is not null and page_number is not null and clean_text is not null").groupBy("document_id", "page_number").agg(F.min("clean_text").alias("clean_text"))
    sample = hashed_sample(pages, F.xxhash64("document_id", "page_number"), most, pages.count())
    rows = scans.join(F.broadcast(sample), ["document_id", "page_number"]).select("document_id", "page_number", "chunk_index", "chunk_id", "content", "clean_text").collect()
    texts: dict[tuple, list] = {}
    for r in rows:
        texts.setdefault((r.document_id, r.page_number, r.clean_text), []).append((r.chunk_index, r.chunk_id, r.content))
    counts: Counter[tuple[str, str]] = Counter()
    meant: Counter[str] = Counter()
    for (_, _, clean), parts in sorted(texts.items()):
        scan = re.sub(rf"[{MARKS}]\n\s*(?=\S)", "", "\n".join(c for _, _, c in sorted(parts)))
        a, b = TOKEN.findall(scan.lower()), TOKEN.findall(clean.lower())
        for w in b:
            meant.update(w)
            meant.update(x + y for x, y in zip(w, w[1:]))
        for op, i1, i2, j1, j2 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
            if op == "replace" and i2 - i1 == j2 - j1:
                for x, y in zip(a[i1:i2], b[j1:j2]):
                    k = 0
                    while k < min(len(x), len(y)) and x[k] == y[k]:
                        k += 1
                    e = 0
                    while e < min(len(x), len(y)) - k and x[-1 - e] == y[-1 - e]:
                        e += 1
                    bad, good = x[k : len(x) - e], y[k : len(y) - e]
                    for grown in range(2):  # a part that is empty takes a neighbour
                        if (not bad or not good) and k:
                            k -= 1
                            bad, good = x[k : len(x) - e], y[k : len(y) - e]
                    if bad and good and len(bad) <= 2 and len(good) <= 2:
                        counts[bad, good] += 1
    return Channel(counts, meant)


def scan_lines(links: DataFrame) -> DataFrame:
    """(chunk_id, line_no, hyphen, words, at, rest): the lines of scans with their words in lower case, the length of a word's part on its line, and the line of the rest (0: none, -1: in the next chunk)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in batches:
            out = []
            for chunk, text, gone, next_word, broken in zip(*(batch.column(c).to_pylist() for c in ("chunk_id", "content", "gone", "next_word", "broken_before"))):
                for n, words, hyphen in line_words(text, gone, next_word, broken):
                    if words:
                        out.append((chunk, n, hyphen, [w.lower() for w, _, _ in words], [a for _, a, _ in words], [r for _, _, r in words]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names=["chunk_id", "line_no", "hyphen", "words", "at", "rest"])

    return links.select("chunk_id", "content", "gone", "next_word", "broken_before").mapInArrow(run, "chunk_id string, line_no int, hyphen boolean, words array<string>, at array<int>, rest array<int>")


def candidates(lines: DataFrame, words: DataFrame, channel: Channel, least_seen: int = LEAST_SEEN) -> DataFrame:
    """(word, c): the words of scans that may have to be read otherwise, each with its candidates (score, meant), best first.

    A word may be what it is, or any word that other documents have least_seen times and that up to two confusions make
    of it. A score is the channel's log probability plus the log of the word's count. Pairs of neighbours add something
    between 0 and what a pair counted as often as the word itself would add, on either side: only candidates that lose
    whatever the neighbours are get left out, so decoding gives what it would give with all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for w in batch.column(0).to_pylist():
                if w.isdigit():
                    continue
                found = channel.meanings(w)
                if len(w) >= 5:
                    found = channel.meanings_twice(w) | found
                found.pop(w, None)
                out += [(w, m, c) for m, c in found.items()]
                out.append((w, w, 0.0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, [pa.string(), pa.string(), pa.float64()])], names=["word", "meant", "cost"])

    distinct = lines.select(F.explode("words").alias("word")).distinct()
    made = distinct.repartition(partitions(lines.sparkSession)).mapInArrow(run, "word string, meant string, cost double")
    itself = F.col("word") == F.col("meant")
    met = made.join(words.select(F.col("word").alias("meant"), "n"), "meant", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(itself | (F.col("n") >= least_seen))
    score = F.col("cost") + F.log(F.col("n") + UNSEEN)
    most = score + 2 * F.log1p(F.col("n") / PAIR_PRIOR)
    of = met.groupBy("word").agg(F.max(score).alias("best"), F.collect_list(F.struct(score.alias("score"), most.alias("most"), "meant")).alias("c"))
    kept = F.transform(F.sort_array(F.filter("c", lambda x: x["most"] >= F.col("best")), asc=False), lambda x: F.struct(x["score"].alias("score"), x["meant"].alias("meant")))
    return of.select("word", kept.alias("c")).where(F.exists("c", lambda x: x["meant"] != F.col("word")))


def word_key(words: list[str]) -> np.ndarray:
    return signed(mix(string_hashes(words)))


def open_words(lines: DataFrame, several: DataFrame) -> DataFrame:
    """(chunk_id, line_no, k, word, at, rest_line, before, after, c): the words of lines, by place k, that have candidates.

    The filter keeps the words without any from being shuffled.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(word_key(batch.column(0).to_pylist()))], names=["key"])

    filtered = lines.sparkSession.sparkContext.broadcast(bloom(several.select("word").mapInArrow(keys, "key long"), several.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        passes: dict[str, bool] = {}
        for batch in batches:
            out = []
            lists = batch.column("words").to_pylist()
            new = list({w for words in lists for w in words}.difference(passes))
            if len(passes) > MOST_HELD:
                passes.clear()
                new = list({w for words in lists for w in words})
            if new:
                passes.update(zip(new, filtered.value.holds(word_key(new)).tolist()))
            for chunk, n, words, at, rest in zip(batch.column("chunk_id").to_pylist(), batch.column("line_no").to_pylist(), lists, batch.column("at").to_pylist(), batch.column("rest").to_pylist()):
                for k, w in enumerate(words):
                    if passes[w]:
                        out.append((chunk, n, k, w, at[k], rest[k], words[k - 1] if k else None, words[k + 1] if k + 1 < len(words) else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)], names=["chunk_id", "line_no", "k", "word", "at", "rest_line", "before", "after"])

    found = lines.select("chunk_id", "line_no", "words", "at", "rest").mapInArrow(run, "chunk_id string, line_no int, k int, word string, at int, rest_line int, before string, after string")
    return found.join(several, "word")


def steps(words: list[dict]) -> Iterator[tuple[list[str], list[str]]]:
    """(left, right) of a line's places with candidates: the readings on either side of each border that one of them touches."""
    for i, w in enumerate(words):
        here = [c["meant"] for c in w["c"]]
        if i and words[i - 1]["k"] == w["k"] - 1:
            yield [c["meant"] for c in words[i - 1]["c"]], here
        elif w["before"]:
            yield [w["before"]], here
        if w["after"] and not (i + 1 < len(words) and words[i + 1]["k"] == w["k"] + 1):
            yield here, [w["after"]]


def decoded(lines: DataFrame, words: DataFrame, pairs: DataFrame, channel: Channel) -> DataFrame:
    """(chunk_id, line_no, k, word, at, rest_line, meant): the words of scans that stand for another word.

    Each line is decoded by Viterbi over the candidates of all its words, with the counts of neighbouring pairs; a word
    without other candidates is a place with one. pairs: (pair, n).
    """
    several = written(candidates(lines, words, channel), "candidates")
    parts = ["k", "word", "at", "rest_line", "before", "after", "c"]
    lattice = open_words(lines, several).groupBy("chunk_id", "line_no").agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("w"))
    lattice = written(lattice, "lattices")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each, keys = line_pairs(batch.column(2).to_pylist())
            rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in each]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(keys)], names=["chunk_id", "line_no", "pair"])

    need = lattice.mapInArrow(wanted, "chunk_id string, line_no int, pair long").join(pairs, "pair")
    counts = need.groupBy("chunk_id", "line_no").agg(F.collect_list(F.struct("pair", "n")).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        for batch in batches:
            out = []
            lists = batch.column("w").to_pylist()
            each, keys = line_pairs(lists)
            at = 0
            for chunk, n, words, both, counted in zip(batch.column("chunk_id").to_pylist(), batch.column("line_no").to_pylist(), lists, each, batch.column("p").to_pylist()):
                by_key = {p["pair"]: p["n"] for p in counted or []}
                seen = {p: by_key[x] for p, x in zip(both, keys[at : at + len(both)].tolist()) if x in by_key} if by_key else {}
                at += len(both)
                for w, m in zip(words, viterbi(words, seen)):
                    if m != w["word"]:
                        out.append((chunk, n, w["k"], w["word"], w["at"], w["rest_line"], m))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)], names=["chunk_id", "line_no", "k", "word", "at", "rest_line", "meant"])

    rows = lattice.join(counts, ["chunk_id", "line_no"], "left").select("chunk_id", "line_no", "w", "p")
    return rows.mapInArrow(run, "chunk_id string, line_no int, k int, word string, at int, rest_line int, meant string")


def line_pairs(lines: list[list[dict]]) -> tuple[list[list[tuple[str, str]]], np.ndarray]:
    """Of each line the pairs of readings that can stand next to each other, and the keys of all of them, one after another."""
    each = [list({(a, b) for lefts, rights in steps(w) for a in lefts for b in rights}) for w in lines]
    names = list({w for both in each for pair in both for w in pair})
    if not names:
        return each, np.empty(0, np.int64)
    hashes, at = mix(string_hashes(names)), {w: k for k, w in enumerate(names)}
    return each, pair_keys(*(hashes[[at[pair[side]] for both in each for pair in both]] for side in (0, 1)))


def viterbi(words: list[dict], seen: dict[tuple[str, str], int]) -> list[str]:
    """The likeliest readings of a line's places with candidates (k, before, after, c), in order; seen: counts of pairs.

    A place with one reading parts what is left of it from what is right, so the path starts anew behind it.
    """

    def bonus(a: str | None, b: str | None) -> float:
        n = seen.get((a, b), 0)
        return log(n / PAIR_PRIOR + 1) if n else 0.0

    out: list[str] = []
    paths: dict[str, tuple[float, list[str]]] = {}
    for i, w in enumerate(words):
        if i and words[i - 1]["k"] == w["k"] - 1:
            paths = {c["meant"]: max((s + bonus(m, c["meant"]) + c["score"], [*path, c["meant"]]) for m, (s, path) in paths.items()) for c in w["c"]}
        else:
            paths = {c["meant"]: (c["score"] + bonus(w["before"], c["meant"]), [c["meant"]]) for c in w["c"]}
        if not (i + 1 < len(words) and words[i + 1]["k"] == w["k"] + 1):
            out += max((s + bonus(m, w["after"]), p) for m, (s, p) in paths.items())[1]
    return out


class Repair:
    """The stages of a repair, each made once: scans, marks, links, by_line (the lines' words), corrections."""

    def __init__(self, chunks: DataFrame, proofread: DataFrame) -> None:
        self.scans, self.words, self.pairs = sorted_out(chunks)
        self.marks = written(page_marks(self.scans), "page_marks")
        self.links = written(linked(self.scans, self.marks), "linked")
        self.channel = learned(self.scans, proofread)
        self.by_line = written(scan_lines(self.links), "scan_lines")
        self.corrections = written(decoded(self.by_line, self.words, self.pairs, self.channel), "corrections")

    def lines(self) -> DataFrame:
        """(chunk_id, line_no, kind)."""
        hyphen = self.by_line.where("hyphen").select("chunk_id", "line_no", F.lit("hyphen").alias("kind"))
        marks = self.marks.select("chunk_id", "line_no", F.explode(F.array(F.when(F.col("header"), "header"), F.when(F.col("page_number"), "page_number"))).alias("kind")).where("kind is not null")
        here = F.col("differs") < F.col("at")
        wrong = self.corrections.withColumn("differs", first_difference("word", "meant"))
        own = wrong.where(here | (F.col("rest_line") >= 0)).select("chunk_id", F.when(here | (F.col("rest_line") == 0), F.col("line_no")).otherwise(F.col("rest_line")).alias("line_no"))
        over = wrong.where(~here & (F.col("rest_line") == -1)).select("chunk_id").join(self.links.select("chunk_id", "next_chunk", "next_line"), "chunk_id").where("next_chunk is not null").select(F.col("next_chunk").alias("chunk_id"), F.col("next_line").alias("line_no"))
        misread = own.unionByName(over).withColumn("kind", F.lit("misread"))
        return hyphen.unionByName(marks).unionByName(misread).distinct()

    def pages(self) -> DataFrame:
        """(document_id, page_number, text, affected): each page's paragraphs, parted by empty lines, and the lines that were affected.

        A word broken over two pages stands on the page where it begins. Chunks without page_number make a page with a null number.
        """
        fixes = self.corrections.groupBy("chunk_id").agg(F.collect_list(F.struct("line_no", "word", "meant")).alias("fixes"))
        affected = self.lines().groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "kind"))).alias("affected"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [repaired(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("content", "gone", "next_word", "broken_before", "fixes")))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("chunk_id", "document_id", "page_number", "chunk_index", "affected")), pa.array(texts, pa.string())], names=["chunk_id", "document_id", "page_number", "chunk_index", "affected", "text"])

        rows = self.links.join(fixes, "chunk_id", "left").join(affected, "chunk_id", "left").select("chunk_id", "document_id", "page_number", "chunk_index", "content", "gone", "next_word", "broken_before", "fixes", "affected")
        done = rows.mapInArrow(run, "chunk_id string, document_id string, page_number int, chunk_index int, affected array<struct<line_no:int,kind:string>>, text string")
        page = done.groupBy("document_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_id", "text", "affected"))).alias("c"))
        marks = F.flatten(F.transform("c", lambda c: F.transform(F.coalesce(c["affected"], F.array().cast("array<struct<line_no:int,kind:string>>")), lambda a: F.struct(c["chunk_id"].alias("chunk_id"), a["line_no"].alias("line_no"), a["kind"].alias("kind")))))
        # a chunk that begins a paragraph starts with an empty line
        text = F.regexp_replace(F.array_join(F.filter(F.transform("c", lambda c: c["text"]), lambda t: t != ""), " "), r" *\n\n *", "\n\n")
        return page.select("document_id", "page_number", F.trim(F.regexp_replace(text, r"^\n+|\n+$", "")).alias("text"), marks.alias("affected"))


def first_difference(a: str, b: str) -> F.Column:
    """Index of the first character in which two string columns differ."""
    n = F.greatest(F.length(a), F.length(b))
    return F.coalesce(F.array_min(F.filter(F.sequence(F.lit(1), n), lambda i: F.substring(F.col(a), i, F.lit(1)) != F.substring(F.col(b), i, F.lit(1)))), n) - 1


def repaired(text: str, gone: list[int], next_word: str | None, broken_before: bool, fixes: list[dict] | None) -> str:
    """A chunk's text as flowing paragraphs: without marks, broken words joined, misread words replaced; case is kept."""
    by_line: dict[int, dict[str, str]] = {}
    for f in fixes or []:
        by_line.setdefault(f["line_no"], {})[f["word"]] = f["meant"]
    lines, skip = text.split("\n"), set(gone)
    out: list[str] = []
    cut, last = False, ""
    width = max((len(x.rstrip()) for k, x in enumerate(lines, 1) if k not in skip), default=0)
    for n, words, hyphen in line_words(text, gone, next_word, broken_before):
        line = lines[n - 1]
        if n in skip:
            continue
        # a sentence's end that left room for the next line's first word ends a paragraph
        room = last and last[-1] in ".?!;" and len(last) + 1 + len(line.split()[0] if line.split() else "") < 0.95 * width
        last = line.rstrip()
        if not line.strip():
            if out and not cut:
                out.append("\n\n")
            continue
        lone = line.strip().isdigit() or line.isupper() and title(line)  # a number or a heading by itself
        if out and out[-1] != "\n\n" and (room or lone or len(line) - len(line.lstrip()) >= 3):
            out.append("\n\n")
        elif not out and len(line) - len(line.lstrip()) >= 3:
            out.append("\n\n")
        body = line.strip()
        all_words = TOKEN.findall(line)
        if len(words) < len(all_words):  # the line goes on with the rest of a word that stands before
            m = STARTS.match(body)
            body = body[m.end() :] if m else body
            end = re.match(r"[.,;:?!)]*", body)[0]  # marks behind the word go where it stands
            if out and out[-1] != "\n\n":
                out[-1] += end
            body = body[len(end) :].strip()
        if hyphen:
            body = BROKEN.sub(lambda m, w=words[-1][0]: w, body)
            if words[-1][2] == -1:
                body += next_word[STARTS.match(next_word).end() :]
        known = by_line.get(n, {})
        if known:
            body = TOKEN.sub(lambda m: cased(m[0], known[m[0].lower()]) if m[0].lower() in known else m[0], body)
        cut = False
        if body:
            out.append(body)
        if lone:
            out.append("\n\n")
    joined = " ".join(out)
    return re.sub(r" *\n\n( *\n\n)* *", "\n\n", joined)


def cased(was: str, meant: str) -> str:
    letters = [c for c in was if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return meant.upper()
    return meant[:1].upper() + meant[1:] if letters and was[:1].isupper() else meant


def affected_lines(chunks: DataFrame, proofread: DataFrame) -> DataFrame:
    """(chunk_id, line_no, kind): the lines of scanned documents with a broken word (hyphen), a misread word (misread), a running head (header) or the page's number (page_number).

    Rows of a chunk_id count once. Null ids and contents give nothing; null page numbers are guessed from the chunks
    around. Without proofread pages the confusions are those of a fixed list. Other columns aren't read.
    """
    return Repair(chunks, proofread).lines()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affected_lines(table(spark, sf_dir, "document_chunks"), table(spark, sf_dir, "proofread_pages"))


def p2_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Repair(table(spark, sf_dir, "document_chunks"), table(spark, sf_dir, "proofread_pages")).pages()
