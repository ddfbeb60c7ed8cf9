"""Problem 7: byte-level BPE encoding of a whole corpus.

The merge table is compiled into a transducer over bytes whose states are made on first use (lazy determinisation).
A state stands for a prefix of a pre-token; it stores the last token of that prefix's encoding and the state where
that token begins. On reading a byte the transducer looks for the one token that ends here and is compatible with
the last token of the state where it begins. The next token begins no further back than the longest token is long, so
where the paths back from all these places have met, what lies before is settled and leaves: memory and lookahead are
bounded by that, not by the pre-token. States and outputs of seen pre-tokens are kept, up to a bound after which they are
made anew; those of very long pre-tokens aren't.
"""

from __future__ import annotations

import base64
import importlib.util
import itertools
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import table

SPACE = r"\t-\r\x20\x85\xa0  -     　"
# Fixed value: the pre-tokens of the public byte-level BPE vocabulary of 50k tokens.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: The same on texts of ASCII characters only, for the faster matcher.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r\x20A-Za-z0-9]+|[\t-\r\x20]+(?![^\t-\r\x20])|[\t-\r\x20]+"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """The file of a public vocabulary: in folder, or in the installed package of public tokenizers."""
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = str(Path(spec.origin).parent) if spec and spec.origin else "/opt/tokenizers"
    return f"{folder}/{name}"


class Transducer:
    """Encoder of one rank table. encode() gives ids; decode_stream() reads ids piece by piece."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = 2_000_000, most_outputs: int = 500_000) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.longest = max(map(len, ranks))
        # lengths of the tokens that end with the same two bytes, the longest first
        ends: dict[bytes, set[int]] = {}
        for b in ranks:
            ends.setdefault(b[-2:], set()).add(len(b))
        self.ends = {e: sorted(n, reverse=True) for e, n in ends.items()}
        self.most_states, self.most_outputs = most_states, most_outputs
        self.compatible: dict[int, bool] = {}
        self.outputs: dict[str, tuple[int, ...]] = {}
        self.restart()

    @classmethod
    def load(cls, path: str) -> Transducer:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def restart(self) -> None:
        # of state s: arcs[s] maps a byte to the next state, last[s] is the last token, start[s] the state where it begins
        self.arcs: list[dict[int, int]] = [{}]
        self.last: list[int] = [-1]
        self.start: list[int] = [0]

    def merged(self, text: bytes) -> list[int]:
        """Plain merging of neighbours by least rank; used on pairs of tokens only."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """True if left, right is the encoding of the two tokens' bytes."""
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) > 4 * self.most_states:
                self.compatible.clear()
            if left < 0:
                known = self.merged(self.bytes_of[right]) == [right]
            else:
                known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.compatible[key] = known
        return known

    def run(self, piece: bytes) -> tuple[int, ...]:
        """Tokens of one pre-token."""
        if len(self.last) > self.most_states:
            self.restart()
        if len(piece) > 64 * self.longest:
            return tuple(self.stream(piece))
        path, state = [0], 0
        for i, byte in enumerate(piece):
            to = self.arcs[state].get(byte)
            if to is None:
                token, start = self.step(piece, i + 1, path)
                to = len(self.last)
                self.arcs[state][byte] = to
                self.arcs.append({})
                self.last.append(token)
                self.start.append(start)
            state = to
            path.append(state)
        out = []
        while state:
            out.append(self.last[state])
            state = self.start[state]
        return tuple(reversed(out))

    def step(self, piece: bytes, end: int, path: list[int]) -> tuple[int, int]:
        for size in self.sizes(piece, end):
            if size <= end:
                token = self.ranks.get(piece[end - size : end])
                if token is not None and self.fits(self.last[path[end - size]], token):
                    return token, path[end - size]
        raise ValueError("the vocabulary lacks a byte")

    def sizes(self, piece: bytes, end: int) -> list[int]:
        """How long a token that ends here may be, longest first."""
        return [*self.ends.get(piece[max(0, end - 2) : end], ()), 1] if end > 1 else [1]

    def stream(self, piece: bytes, every: int = 1024) -> Iterator[int]:
        """Tokens of one pre-token of any length, each as soon as it is settled; no states are kept."""
        base, last = 0, [-1]  # last[i]: the last token of the prefix that ends at base + i
        for end in range(1, len(piece) + 1):
            for size in self.sizes(piece, end):
                at = end - size - base
                if at < 0:
                    continue
                token = self.ranks.get(piece[end - size : end])
                if token is not None and self.fits(last[at], token):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if end % every == 0:
                # the paths back from every place where a later token can begin: where they meet, all before is settled
                places = set(range(max(base, end + 1 - self.longest), end + 1))
                while len(places) > 1:
                    far = max(places)
                    places.remove(far)
                    places.add(far - self.length[last[far - base]])
                meet = places.pop()
                if meet > base:
                    yield from self.back(last, meet - base)
                    last, base = last[meet - base :], meet
        yield from self.back(last, len(piece) - base)

    def back(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= self.length[last[end]]
        return out[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for null and for the empty text. Lone surrogates count as U+FFFD."""
        if not text:
            return []
        pieces = (ASCII_PIECES if text.isascii() else PIECES).findall(text)
        outputs = self.outputs
        missing = set(pieces).difference(outputs)
        if missing:
            if len(outputs) + len(missing) > self.most_outputs:
                outputs = self.outputs = {}
                missing = set(pieces)
            for p in missing:
                outputs[p] = self.run(p.encode("utf-8", "replace") if p.isascii() else p.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode())
        return list(itertools.chain.from_iterable(map(outputs.__getitem__, pieces)))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of ids, as soon as whole characters are there; a byte that can't go on gives U+FFFD."""
        machine = Utf8()
        for i in ids:
            if out := machine.feed(self.bytes_of[i]):
                yield out
        if out := machine.end():
            yield out

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_stream(ids))


class Utf8:
    """UTF-8 decoding as a state machine: the bytes still wanted, their allowed range, the code point so far."""

    def __init__(self) -> None:
        self.want, self.low, self.high, self.point = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.want:
                if self.low <= b <= self.high:
                    self.point = self.point << 6 | b & 0x3F
                    self.want, self.low, self.high = self.want - 1, 0x80, 0xBF
                    if not self.want:
                        out.append(chr(self.point))
                    continue
                out.append("�")
                self.want, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.want, self.point = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.want, self.point = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.want, self.point = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        out = "�" if self.want else ""
        self.__init__()
        return out




PIECES, ASCII_PIECES = regex.compile(PATTERN), re.compile(ASCII_PATTERN)
_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The transducer of a vocabulary file, one in each Python process."""
    if path not in _loaded:
        _loaded[path] = Transducer.load(path)
    return _loaded[path]


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids ARRAY<INT>): the tokens of every row's text, special tokens' strings taken as ordinary text.

    One row for each row of documents, repeated rows too, in one pass without a shuffle. Null and empty texts give
    an empty list; a null key stays null; other columns are not read. Very long texts take memory of their own size.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        t = transducer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [t.encode(x) for x in part.column(1).to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                values = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=[key, "ids"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """(key, text): the text of every row's ids, by the incremental decoder; null and no ids give the empty text. Ids that the vocabulary lacks raise."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=[key, "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def p7_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return decode(encode(table(spark, sf_dir, "documents")))


P7_TEXTS_SQL = "select doc_id, coalesce(text, '') as text from documents"
