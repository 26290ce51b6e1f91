"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all texts of the learning folds. The weights
are learned by follow-the-regularised-leader (FTRL-proximal) with elastic
net on a bounded sample; a part of the sample that it does not learn from sets
the temperature that calibrates the probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, hash_sample, text_of

BUCKETS = 1 << 15
PIECE = 1 << 18
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}").search
_MULTIPLY = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def _grams(data: bytes, own: int) -> np.ndarray:
    """Hash buckets of all 1- to 3-grams of the code points (UTF-32 bytes) that start among the first ``own``."""
    c = np.frombuffer(data, np.uint32)
    parts, h = [], np.zeros(len(c), np.uint32)
    for n, m in enumerate(_MULTIPLY):
        if len(c) <= n:
            break
        h = h[: len(c) - n] + (c[n:] + np.uint32(n + 1)) * m
        x = h[:own]
        x = x ^ (x >> np.uint32(15))
        x = x * np.uint32(0x2C1B3C6D)
        parts.append((x ^ (x >> np.uint32(13))) >> np.uint32(17))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _counts(text: str):
    """(bucket, count) of a lower-cased text, in pieces so that a long text needs little memory."""
    total = np.zeros(BUCKETS, np.int64)
    low = text.lower()
    for a in range(0, len(low), PIECE):
        piece = low[a:a + PIECE + 2].encode("utf-32-le", "surrogatepass")
        total += np.bincount(_grams(piece, PIECE), minlength=BUCKETS)
    ids = np.flatnonzero(total)
    return ids, total[ids]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray      #: bucket x language, mostly zero
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str):
        ids, n = _counts(text)
        x = (1 + np.log(n)) * self.idf[ids]
        norm = np.sqrt((x * x).sum())
        return ids, (x / norm if norm else x).astype(np.float32)

    def logits(self, ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[ids] + self.bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list, classes: int, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
    """FTRL-proximal with per-coordinate rates; rows are (ids, x, class). Returns (weights, bias)."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(ids):
        zi = z[ids]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[ids])) / alpha + l2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    for epoch in range(epochs):
        for at in np.random.default_rng(epoch).permutation(len(rows)):
            ids, x, y = rows[at]
            ids, x = np.append(ids, BUCKETS), np.append(x, 1.0)
            w = weights(ids)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:BUCKETS].astype(np.float32), w[BUCKETS]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    def loss(t):
        p = _softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    a, b, r = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _frequencies(batches):
    total, texts = np.zeros(BUCKETS, np.int64), 0
    for pdf in batches:
        for text in pdf["text"]:
            total[_counts(text)[0]] += 1
            texts += 1
    yield pd.DataFrame({"bucket": np.append(np.arange(BUCKETS), -1), "texts": np.append(total, texts)})


def _sparse(batches):
    for pdf in batches:
        rows = []
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            ids, n = _counts(text)
            rows.append((lang, ids.astype(np.int32).tobytes(), n.astype(np.int32).tobytes()))
        yield pd.DataFrame(rows, columns=["lang", "ids", "counts"])


def train_language_id(docs: DataFrame, folds: int = 4, held_out: int = 2, sample_rows: int = 6_000) -> LanguageModel:
    """Learn from text and non-null lang of rows outside the held-out fold (crc32 of doc_id as text, modulo ``folds``).

    Document frequencies count all these texts; FTRL and temperature see the
    ``sample_rows`` ids with the smallest hash, one text each, every fifth
    for the temperature only. Without such rows the model knows no language.
    """
    learn = (docs.select("doc_id", text_of(docs).alias("text"), F.col("lang").cast("string").alias("lang"))
             .where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), folds) != held_out)))
    counted = learn.select("text").mapInPandas(_frequencies, "bucket int, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts"))
    freq = {r["bucket"]: r["texts"] for r in counted.collect()}  # one row per bucket
    texts = freq.get(-1, 0)
    idf = np.log((1 + texts) / (1 + np.array([freq.get(i, 0) for i in range(BUCKETS)], np.float64))) + 1
    sample = hash_sample(learn.withColumn("key", F.col("doc_id")).drop("doc_id"), "key", sample_rows, "language-sample")
    rows = sample.orderBy("key").select("lang", "text").mapInPandas(_sparse, "lang string, ids binary, counts binary").collect()
    languages = sorted({r["lang"] for r in rows})
    model = LanguageModel(languages, idf, np.zeros((BUCKETS, len(languages)), np.float32), np.zeros(len(languages)))
    data = []
    for r in rows:
        ids, n = np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.int32)
        x = (1 + np.log(n)) * idf[ids]
        if len(x):
            data.append((ids, x / np.sqrt((x * x).sum()), languages.index(r["lang"])))
    if data and len(languages) > 1:
        hold = data[::5] if len(data) >= 20 else []
        fit = [d for i, d in enumerate(data) if i % 5 or not hold]
        model.weights, model.bias = fit_ftrl(fit, len(languages))
        if hold:
            model.temperature = fit_temperature(np.stack([model.logits(i, x) for i, x, _ in hold]), np.array([y for *_, y in hold]))
    return model


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` by its whole text.

    lang_pred is a learned language and score its calibrated probability;
    "und" and 0 for null texts, texts without letters, or a model that knows
    no language. Null doc_ids and repeated rows stay; other columns are not read.
    """
    def run(batches):
        for pdf in batches:
            names, scores = [], []
            for text in pdf["text"]:
                if not model.languages or not _LETTER(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = _softmax(model.logits(*model.features(text)) / model.temperature)
                names.append(model.languages[int(p.argmax())])
                scores.append(float(p.max()))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "lang_pred": names, "score": scores})

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return base.mapInPandas(run, "doc_id long, lang_pred string, score double")
