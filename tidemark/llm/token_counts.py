"""Token counts of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.annotate import annotate
from tidemark.llm.tokens import BATCH_BYTES, encoder
from tidemark.llm.words import text_bytes

FIELDS = "n_bytes long, n_tokens long, over_limit boolean"

_models: dict[str, object] = {}


def _piece_counts(path: str, column: pa.Array) -> np.ndarray:
    """Counts by a sentencepiece model, which sees whole texts."""
    import sentencepiece

    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t or "" for t in column.to_pylist()]
    ids = _models[path].encode(texts, num_threads=1)
    return np.array([len(i) for i in ids], np.int64)


def count(column: pa.Array, path: str, limit: int) -> dict[str, pa.Array]:
    offsets, _ = text_bytes(column)
    if path.endswith(".model"):
        counts = _piece_counts(path, column)
    else:
        counts, _ = encoder(path, keep_ids=False).encode(column)
    return {
        "n_bytes": pa.array(np.diff(offsets), pa.int64()),
        "n_tokens": pa.array(counts, pa.int64()),
        "over_limit": pa.array(counts > limit),
    }


def with_token_counts(
    docs: DataFrame, path: str, limit: int = 512, name: str = "tokens"
) -> DataFrame:
    """``docs`` with a struct column: bytes, tokens, and whether they exceed ``limit``.

    ``path`` is a tokenizer file: .model for sentencepiece, else one of the
    tokenizers library. No special tokens are added; those written in a text
    count as the library takes them. Batches have about the same number of
    bytes; a long text is cut at places where the tokenizer always splits.

    A null text counts as empty, with no tokens. Repeated rows, nulls in other
    columns and further columns pass through; an empty table stays empty.
    """
    return annotate(
        docs, lambda part: count(part["text"], path, limit), FIELDS, name, slice_bytes=BATCH_BYTES
    )
