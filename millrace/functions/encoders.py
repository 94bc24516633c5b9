"""Text encoders. An encoder maps a list of texts to a float matrix, one row per text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

Encoder = Callable[[Sequence[str]], np.ndarray]
DIMENSIONS = 384  # fixed value: length of a stored embedding


def hashing_encoder(dimensions: int = DIMENSIONS) -> Encoder:
    """Signed hashed byte trigrams of the whole text, scaled to length 1. Needs no model files."""

    def encode(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), dtype=np.float32)
        for row, text in enumerate(texts):
            data = np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8).astype(np.uint64)
            if len(data) < 3:
                continue
            grams = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
            mixed = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            slots = (mixed >> np.uint64(1)) % np.uint64(dimensions)
            signs = np.where(mixed & np.uint64(1), 1.0, -1.0)
            vector = np.bincount(slots.astype(np.int64), weights=signs, minlength=dimensions)
            norm = np.linalg.norm(vector)
            if norm > 0:
                out[row] = vector / norm
        return out

    return encode


def sentence_encoder(model: str = "sentence-transformers/all-MiniLM-L6-v2") -> Encoder:
    """The sentence model; needs the ``sentence_transformers`` package on every worker."""
    from sentence_transformers import SentenceTransformer

    return SentenceTransformer(model).encode
