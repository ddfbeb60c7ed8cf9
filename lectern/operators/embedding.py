"""Embedders. A deterministic feature-hashing embedder is built in; others plug in as a function from texts to vectors."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.content import embedding_type, known_types

Embedder = Callable[[list[str]], "np.ndarray"]


class Hashing:
    """The built-in embedder: each lower-cased word is hashed (md5) to a component and a sign; sums are scaled to length 1.

    Texts without words give zeros. unit=False leaves the sums as they are.
    """

    def __init__(self, dimension: int = 64, unit: bool = True) -> None:
        self.dimension, self.unit = dimension, unit
        self.known: dict[str, tuple[int, float]] = {}

    def place(self, word: str) -> tuple[int, float]:
        if len(self.known) > 500_000:
            self.known.clear()
        if word not in self.known:
            h = md5(word.encode("utf-8", "surrogatepass")).hexdigest()
            self.known[word] = int(h[:8], 16) % self.dimension, 1.0 if h[8] < "8" else -1.0
        return self.known[word]

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float64)
        for k, t in enumerate(texts):
            for w, n in Counter(t.lower().split()).items():
                i, s = self.place(w)
                out[k, i] += s * n
        if self.unit:
            out /= np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-300)
        return out.astype(np.float32)


def embed(chunks: DataFrame, text: str, embedder: Embedder, dimension: int, model: str = "custom", device: str = "cpu", batch: int = 32, kind: str = "type") -> DataFrame:
    """Chunks of the known types with embedding and embedding_metadata, made batch by batch in Arrow workers.

    embedder maps a list of texts to an array (texts, dimension); it is called in the workers, where it may load a model
    once. Null texts are embedded as empty ones. Chunks of other types are left out.
    """
    rows = known_types(chunks, kind)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            parts = [np.asarray(embedder(texts[at : at + batch]), np.float32).reshape(-1, dimension) for at in range(0, len(texts), batch)]
            flat = np.concatenate(parts).ravel() if parts else np.empty(0, np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dimension), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "embedding"])

    out = rows.mapInArrow(run, f"{fields}, embedding array<float>")
    return with_metadata(out, model, dimension, device, kind).drop("type_order")


def with_metadata(chunks: DataFrame, model: str, dimension: int, device: str, kind: str = "type") -> DataFrame:
    return chunks.withColumn("embedding_metadata", F.struct(F.lit(model).alias("model"), F.lit(dimension).alias("dimension"), F.lit(device).alias("device"), embedding_type(F.col(kind)).alias("embedding_type")))


def embed_hashing(chunks: DataFrame, text: str, dimension: int = 64, kind: str = "type") -> DataFrame:
    """The same with the built-in embedder."""
    return embed(chunks, text, Hashing(dimension), dimension, "hashing", "cpu", 1024, kind)


def choose_device(explicit: str | None = None, preferred: str | None = None, available: tuple[str, ...] = ("cpu",)) -> str:
    """An explicit device; else the preferred one if it is there; else cuda before mps before cpu."""
    if explicit:
        return explicit
    if preferred in available:
        return preferred
    return next((d for d in ("cuda", "mps") if d in available), "cpu")
