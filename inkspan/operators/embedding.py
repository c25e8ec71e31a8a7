"""Embed texts with a pluggable embedder, by default a local deterministic one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkspan.functions.text import _col, is_blank
from inkspan.schemas import EMBEDDING

# Tokens that a task remembers: some 10 MB.
REMEMBERED_TOKENS = 1 << 16


class Embedder(Protocol):
    """Built once per Python worker; ``embed`` takes one request of texts."""

    model: str

    def embed(self, texts: Sequence[str]) -> tuple[Sequence[Sequence[float]], Sequence[int]]:
        """Vectors of the texts and their token counts."""


class TokenBuckets(dict):
    """Token to bucket; remembers a bounded number of tokens."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: str) -> int:
        digest = hashlib.md5(token.encode("utf-8")).hexdigest()
        bucket = int(digest[:8], 16) % self.dim
        if len(self) < REMEMBERED_TOKENS:
            self[token] = bucket
        return bucket


class HashingEmbedder:
    """Counts lower-cased whitespace tokens in md5 buckets and scales to norm 1."""

    model = "token-hash"

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.buckets = TokenBuckets(dim)

    def embed(self, texts):
        vectors = np.zeros((len(texts), self.dim))
        tokens = []
        for row, text in enumerate(texts):
            words = text.lower().split()
            tokens.append(len(words))
            if words:
                at = np.fromiter(map(self.buckets.__getitem__, words), np.int64, len(words))
                vectors[row] = np.bincount(at, minlength=self.dim)
        lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return np.divide(vectors, lengths, out=vectors, where=lengths > 0), tokens


def choose_embedder(
    provider: str, factories: dict[str, Callable[[], Embedder]]
) -> Callable[[], Embedder]:
    """The factory of one provider, chosen once per job and not per row."""
    try:
        return factories[provider]
    except KeyError:
        raise ValueError(f"unknown provider {provider!r}, have {sorted(factories)}") from None


def embedding(
    text: Column | str,
    factory: Callable[[], Embedder] = HashingEmbedder,
    request_size: int = 256,
    attempts: int = 3,
) -> Column:
    """Struct (model, prompt_tokens, total_tokens, embedding, error) per text.

    Texts go to the embedder in requests of ``request_size``. A failing request
    is tried ``attempts`` times, then its texts one by one, so that one bad text
    gives one row with ``error`` and no vector.
    """
    call = _embedding_udf(factory, request_size, attempts)
    # A call is dear and may differ when repeated: no plan may make it twice.
    return call.asNondeterministic()(_col(text))


def embed_chunks(
    chunks: DataFrame,
    factory: Callable[[], Embedder] = HashingEmbedder,
    request_size: int = 256,
    attempts: int = 3,
) -> DataFrame:
    """Add model, prompt_tokens, total_tokens, chunk_vector and error to chunks.

    Blank texts are dropped before the call.
    """
    made = chunks.filter(~is_blank("text")).withColumn(
        "made", embedding("text", factory, request_size, attempts)
    )
    return made.select(
        *chunks.columns,
        "made.model", "made.prompt_tokens", "made.total_tokens",
        F.col("made.embedding").alias("chunk_vector"),
        "made.error",
    )


def _embedding_udf(factory, request_size: int, attempts: int):
    @F.arrow_udf(EMBEDDING)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embedder = factory()
        for batch in batches:
            # Only the texts and the rows of one request are Python objects at a time.
            made = [
                _struct_array(_request(embedder, batch.slice(at, request_size).to_pylist(), attempts), embedder.model)
                for at in range(0, len(batch), request_size)
            ]
            yield pa.concat_arrays(made) if made else _struct_array([], embedder.model)

    return run


def _request(embedder: Embedder, texts: list[str], attempts: int) -> list[tuple]:
    """One (vector, tokens, error) per text."""
    error = None
    for _ in range(attempts):
        try:
            vectors, tokens = embedder.embed(texts)
            return [(v, n, None) for v, n in zip(vectors, tokens, strict=True)]
        except Exception as e:  # the embedder is foreign code; its failure becomes data
            error = f"{type(e).__name__}: {e}"
    if len(texts) == 1:
        return [(None, None, error)]
    return [row for text in texts for row in _request(embedder, [text], attempts)]


def _struct_array(rows: list[tuple], model: str) -> pa.Array:
    tokens = pa.array([n for _, n, _ in rows], pa.int32())
    sizes = [0 if v is None else len(v) for v, _, _ in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    present = [np.asarray(v, dtype=np.float32) for v, _, _ in rows if v is not None]
    values = np.concatenate(present) if present else np.empty(0, np.float32)
    missing = pa.array([v is None for v, _, _ in rows])
    item = pa.field("element", pa.float32(), nullable=False)
    vectors = pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values), type=pa.list_(item), mask=missing
    )
    columns = [
        pa.array([None if v is None else model for v, _, _ in rows], pa.string()),
        tokens, tokens, vectors,
        pa.array([e for _, _, e in rows], pa.string()),
    ]
    return pa.StructArray.from_arrays(columns, names=EMBEDDING.fieldNames())
