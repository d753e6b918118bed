"""Turning texts into vectors inside the plan.

An embedder is a factory, called once per Python worker, that returns ``list[str] -> list[list[float]]``. Neural models
plug in there; ``hashing_embedder`` is a deterministic stand-in without weights.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Embed = Callable[[list[str]], list[list[float]]]
#: Batch sizes for local models, for services, and where neither says otherwise.
LOCAL_BATCH, CLOUD_BATCH, DEFAULT_BATCH = 128, 512, 64


def batches(texts: list[str], size: int | None, most: int | None = None) -> Iterator[list[str]]:
    n = size or most or DEFAULT_BATCH
    if n < 1:
        raise ValueError("the batch size must be positive")
    for i in range(0, len(texts), n):
        yield texts[i : i + n]


def embed_column(factory: Callable[[], Embed], col: str, batch_size: int = LOCAL_BATCH) -> Column:
    """``ARRAY<FLOAT>`` per text, order kept; null text gives a null vector."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = factory()
        for s in parts:
            present = [x for x in s if x is not None]
            got = iter([v for b in batches(present, batch_size) for v in f(b)])
            yield pd.Series([None if x is None else np.asarray(next(got), np.float32) for x in s], dtype=object)

    return run(col)


def embed_table(factory: Callable[[], Embed], docs: DataFrame, id_col: str, text_col: str, batch_size: int = LOCAL_BATCH) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), embed_column(factory, text_col, batch_size).alias("vector"))


def resolve_vectors(df: DataFrame, factory: Callable[[], Embed] | None, text_col: str = "document") -> DataFrame:
    """Given vectors win for the whole call; else texts are embedded; else vectors are null."""
    if "vector" in df.columns:
        return df
    if factory is None or text_col not in df.columns:
        return df.withColumn("vector", F.lit(None).cast("array<float>"))
    return df.withColumn("vector", embed_column(factory, text_col))


def hashing_embedder(dim: int = 64) -> Callable[[], Embed]:
    """Signed hashed words, scaled to length 1; a text without words is the zero vector.

    The first eight hex digits of a word's MD5 give its place, an odd ninth digit the sign.
    """

    def factory() -> Embed:
        import hashlib
        import re

        seen: dict[str, tuple[int, float]] = {}

        def at(w: str) -> tuple[int, float]:
            if w not in seen:
                if len(seen) > 1 << 18:
                    seen.clear()
                h = hashlib.md5(w.encode()).hexdigest()
                seen[w] = int(h[:8], 16) % dim, 1.0 if int(h[8], 16) % 2 else -1.0
            return seen[w]

        def f(texts: list[str]) -> list[list[float]]:
            out = np.zeros((len(texts), dim))
            for i, t in enumerate(texts):
                for w in re.findall(r"\w+", t.lower()):
                    k, sign = at(w)
                    out[i, k] += sign
                out[i] /= np.sqrt((out[i] ** 2).sum()) or 1.0
            return out.tolist()

        return f

    return factory


def mean_pool(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Masked mean over positions of ``(batch, positions, dim)``; the divisor is at least 1e-9."""
    m = np.asarray(mask, float)[..., None]
    return (np.asarray(hidden, float) * m).sum(1) / np.maximum(m.sum(1), 1e-9)


def service_embedder(url: str, model: str, api_key: str, timeout: float = 120.0, attempts: int = 5, post: Callable | None = None) -> Callable[[], Embed]:
    """A service that answers ``{"data": [{"index", "embedding"}]}``; one request per call, none for no texts."""
    if not api_key:
        raise ValueError("an API key is required")

    def factory() -> Embed:
        def send(body: dict) -> dict:
            r = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {api_key}"})
            with urllib.request.urlopen(r, timeout=timeout) as a:
                return json.load(a)

        def f(texts: list[str]) -> list[list[float]]:
            if not texts:
                return []
            for n in range(attempts):
                try:
                    data = (post or send)({"model": model, "input": texts})["data"]
                    return [d["embedding"] for d in sorted(data, key=lambda d: d["index"])]
                except OSError:
                    if n + 1 == attempts:
                        raise
                    time.sleep(min(8.0, 0.25 * 2**n))
            raise AssertionError

        return f

    return factory


def model_embedder(model_id: str, device: str | None = None, batch_size: int = LOCAL_BATCH) -> Callable[[], Embed]:
    """A sentence-transformers model, by name or local directory, loaded once per worker. Needs that package on the workers."""

    def factory() -> Embed:
        from sentence_transformers import SentenceTransformer

        m = SentenceTransformer(model_id, device=device)
        return lambda texts: m.encode(texts, batch_size=batch_size, convert_to_numpy=True).tolist()

    return factory


def local_embedder(path: str, device: str | None = None, batch_size: int = LOCAL_BATCH, longest: int = 512) -> Callable[[], Embed]:
    """A model in a local directory, loaded once per worker: as saved by sentence-transformers where its files say so, else
    a raw checkpoint of ``transformers`` with masked mean pooling. A directory that is missing on a worker is an error there.
    """

    def factory() -> Embed:
        import os

        if not os.path.exists(path):
            raise FileNotFoundError(f"no model at {path}")
        if packaged(path):
            return model_embedder(path, device, batch_size)()
        try:
            import torch
            from transformers import AutoModel, AutoTokenizer
        except ImportError as e:
            raise RuntimeError(f"{path} holds a raw checkpoint, and transformers is not installed on the workers") from e
        words, model = AutoTokenizer.from_pretrained(path), AutoModel.from_pretrained(path).to(device or "cpu").eval()

        def f(texts: list[str]) -> list[list[float]]:
            out: list[list[float]] = []
            for part in batches(texts, batch_size):
                x = words(part, padding=True, truncation=True, max_length=longest, return_tensors="pt").to(device or "cpu")
                with torch.no_grad():
                    hidden = model(**x).last_hidden_state
                out.extend(mean_pool(hidden.cpu().numpy(), x["attention_mask"].cpu().numpy()).tolist())
            return out

        return f

    return factory


def packaged(path: str) -> bool:
    """Whether a directory holds a model as sentence-transformers saves it."""
    import os

    return any(os.path.exists(os.path.join(path, f)) for f in ("modules.json", "config_sentence_transformers.json"))
