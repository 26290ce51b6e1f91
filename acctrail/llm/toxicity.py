"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Learning sees a bounded sample of labelled texts:
1. words, word beginnings and word ends get the log odds of occurring in a
   toxic text; tokens of toxic texts whose log odds are high are the labelled
   toxic tokens, all others are clean;
2. a two-state chain over the tokens learns weights of these log odds (own and
   neighbours') and its transitions by the exact gradient from forward-backward;
3. a logistic regression maps what the marginals of a text add up to (expected
   count of likely toxic tokens, its share, the largest marginal) to its label.

Forward and backward messages are iterated over all tokens of many texts at
once until they stop changing, which gives the forward-backward result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, hash_sample, stored, text_of
from .textarrays import Words, chunks, prefix_sums, span_hash

_BASE = 0x9E3779B97F4A7C15
HEAD, TAIL = 6, 4
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _lowered(text) -> str:
    if not isinstance(text, str):
        return ""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Tokens(Words):
    """Runs of letters of lower-cased texts, with hashes of the word, its beginning and its end."""

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), _BASE)
        head = np.minimum(self.start + HEAD, self.end)
        tail = np.maximum(self.end - TAIL, self.start)
        self.features = [self.hash, span_hash(sums, _BASE, self.start, head) ^ np.uint64(0x5555),
                         span_hash(sums, _BASE, tail, self.end) ^ np.uint64(0xAAAA)]


def _token_chunks(texts):
    data = [_lowered(t).encode("utf-8", "surrogatepass").translate(_BLANK) for t in texts]
    for at, part in chunks(data):
        yield at, Tokens(part)


@dataclass
class ToxicityModel:
    keys: np.ndarray        #: feature hashes, ascending
    odds: np.ndarray        #: their log odds
    weights: np.ndarray     #: bias, word, beginning, end, neighbours' word, neighbours' beginning
    moves: np.ndarray       #: log transition scores [from, to]
    doc: np.ndarray         #: logistic regression on document sums

    def token_inputs(self, t: Tokens) -> np.ndarray:
        out = np.zeros((len(t.hash), 6), np.float32)
        out[:, 0] = 1
        for i, h in enumerate(t.features):
            if len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                out[:, 1 + i] = np.where(self.keys[at] == h, self.odds[at], 0)
        for i in (1, 2):
            v = out[:, i]
            same = t.doc[1:] == t.doc[:-1]
            out[1:, 3 + i] += np.where(same, v[:-1], 0)
            out[:-1, 3 + i] += np.where(same, v[1:], 0)
        return out

    def marginals(self, inputs: np.ndarray, doc: np.ndarray) -> np.ndarray:
        u = inputs @ self.weights.astype(np.float32)
        f, b = messages(u, doc, self.moves)
        return 1 / (1 + np.exp(-(u + f + b)))

    def doc_sums(self, t: Tokens, p: np.ndarray, texts: int) -> np.ndarray:
        sure = p >= 0.5
        total = np.bincount(t.doc[sure], p[sure], texts)
        top = np.zeros(texts)
        np.maximum.at(top, t.doc[sure], p[sure])
        # the 20 keeps the share of a very short text from resting on one token
        share = total / (t.count + 20)
        return np.stack([np.ones(texts), np.log1p(total), np.log(share + 1e-3), top], axis=1)

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums @ self.doc, -30, 30)))


def messages(u: np.ndarray, doc: np.ndarray, moves: np.ndarray, tolerance: float = 1e-4):
    """Forward and backward messages (log odds) of the chains of all documents."""
    e = np.exp(moves - moves.max()).astype(np.float32)
    first = np.ones(len(u), bool)
    first[1:] = doc[1:] != doc[:-1]

    def run(u, first, e):
        f = np.zeros_like(u)
        while len(u):
            x = np.exp(np.clip(u + f, -30, 30))
            g = np.log((x * e[1, 1] + e[0, 1]) / (x * e[1, 0] + e[0, 0]))
            new = np.zeros_like(u)
            new[1:] = g[:-1]
            new[first] = 0
            change = np.abs(new - f).max()
            f = new
            if change < tolerance:
                break
        return f

    last = np.append(first[1:], True)[: len(u)]
    return run(u, first, e), run(u[::-1], last[::-1], e.T)[::-1]


def fit_chain(x: np.ndarray, y: np.ndarray, doc: np.ndarray, steps: int = 120, rate: float = 0.15, l2: float = 1e-3):
    """Weights and transitions maximising the chains' conditional likelihood (Adam on the exact gradient)."""
    w, moves = np.array([-2, 1, .5, .5, 0, 0], np.float64), np.zeros((2, 2))
    link = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[link], y[link + 1]), 1)
    m = v = np.zeros(10)
    for step in range(1, steps + 1):
        u = x @ w.astype(np.float32)
        f, b = messages(u, doc, moves)
        p = 1 / (1 + np.exp(-(u + f + b)))
        left, right = np.exp(np.clip(u + f, -30, 30))[link], np.exp(np.clip(u + b, -30, 30))[link + 1]
        e = np.exp(moves)
        joint = np.stack([np.full(len(link), e[0, 0]), e[0, 1] * right, e[1, 0] * left, e[1, 1] * left * right])
        joint = (joint / joint.sum(0)).sum(1).reshape(2, 2) if len(link) else np.zeros((2, 2))
        grad = np.concatenate([x.T @ (y - p), (seen - joint).ravel()]) / max(1, len(y))
        grad -= l2 * np.concatenate([w, moves.ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        delta = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, moves = w + delta[:6], moves + delta[6:].reshape(2, 2)
    return w, moves


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = l2 * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge @ w)
    return w


def _counts(batches):
    """Texts of each label that hold a feature, summed per task batch."""
    for pdf in batches:
        parts, labels = [], pdf["label"].to_numpy()
        for at, t in _token_chunks(pdf["text"]):
            for h in t.features:
                parts.append(pd.DataFrame({"h": h.view(np.int64), "doc": at + t.doc}).drop_duplicates())
        if parts:
            seen = pd.concat(parts).drop_duplicates()
            seen["toxic"] = labels[seen["doc"]]
            out = seen.groupby("h")["toxic"].agg(["sum", "count"]).reset_index()
            yield out.rename(columns={"sum": "toxic", "count": "texts"}).astype("int64")


def _windows(model: ToxicityModel, size: int, threshold: float):
    """One window of at most ``size`` tokens per text, around its strongest token, with token labels."""
    def run(batches):
        for pdf in batches:
            labels, rows = pdf["label"].to_numpy(), []
            for at, t in _token_chunks(pdf["text"]):
                x = model.token_inputs(t)
                strong = x[:, 1:4].max(1) if len(x) else np.zeros(0)
                for d in np.flatnonzero(t.count):
                    a, b = t.first[d], t.first[d] + t.count[d]
                    a = max(a, min(a + int(strong[a:b].argmax()) - size // 2, b - size))
                    b = min(b, a + size)
                    y = (strong[a:b] >= threshold) & bool(labels[at + d])
                    rows.append((x[a:b].tobytes(), y.astype(np.int8).tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["x", "y"])
    return run


def _scored(model: ToxicityModel, keep: list[str]):
    def run(batches):
        for pdf in batches:
            sums = np.zeros((len(pdf), 4))
            sums[:] = [1, 0, np.log(1e-3), 0]
            for at, t in _token_chunks(pdf["text"]):
                n = len(t.count)
                p = model.marginals(model.token_inputs(t), t.doc)
                sums[at:at + n] = model.doc_sums(t, p, n)
            out = pdf[keep].copy()
            out["sums"] = list(sums)
            out["score"] = model.score(sums)
            yield out
    return run


def train_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, sample_rows: int = 20_000,
                   window: int = 256, window_rows: int = 3_000, min_texts: int = 6, odds_at: float = 3.0,
                   features: int = 1 << 17) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fold (crc32 of doc_id as text, modulo ``folds``).

    Of these, the ``sample_rows`` ids with the smallest hash are used; the chain learns from one
    window of at most ``window`` tokens of at most ``window_rows`` of them. Features are words,
    beginnings and ends in at least ``min_texts`` texts of the sample whose log odds are 1 or more in size;
    the model keeps the ``features`` strongest of them (ties by hash), each under its full 64-bit hash.

    Null labels are not read; an id labelled twice takes the larger label. Null texts count as
    empty, rows with a null doc_id are not drawn, of rows repeated under one doc_id all
    are, and equal texts count once, with their larger label. Without labels of both
    kinds (empty tables too) the model scores every text near 0. Other columns are not read. Runs jobs.
    """
    marks = (labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    marks = hash_sample(marks, "doc_id", sample_rows, "toxic-labels")
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
              .join(F.broadcast(marks), "doc_id"))
    sample = sample.groupBy("text").agg(F.max("label").alias("label"))  # copies count once
    sample = sample.withColumn("key", F.xxhash64("text"))
    sample = stored(sample, "toxic-sample")
    model = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(6), np.zeros((2, 2)),
                          np.array([-30.0, 0, 0, 0]))
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return model
    counted = (sample.select("text", "label").mapInPandas(_counts, "h long, toxic long, texts long")
               .groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"))
               .where(F.col("texts") >= min_texts))
    odds = (F.log((F.col("toxic") + 0.5) / (sizes[1] + 1))
            - F.log((F.col("texts") - F.col("toxic") + 0.5) / (sizes[0] + 1)))
    best = counted.select("h", odds.alias("odds")).where("abs(odds) >= 1").orderBy(F.desc(F.abs("odds")), "h").limit(features)
    table = best.toPandas()
    h = table["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    model.keys, model.odds = h[order], table["odds"].to_numpy(np.float32)[order]

    few = (sample.where("label = 1").orderBy("key").limit(window_rows // 2)
           .unionByName(sample.where("label = 0").orderBy("key").limit(window_rows // 2)))
    rows = few.select("text", "label").mapInPandas(_windows(model, window, odds_at), "x binary, y binary").collect()
    if rows:
        x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, 6) for r in rows])
        y = np.concatenate([np.frombuffer(r["y"], np.int8) for r in rows]).astype(np.int64)
        doc = np.repeat(np.arange(len(rows)), [len(r["y"]) for r in rows])
        model.weights, model.moves = fit_chain(x, y, doc)
    fitted = sample.select("text", "label").mapInPandas(_scored(model, ["label"]), "label int, sums array<double>, score double")
    fitted = fitted.toPandas()
    model.doc = _logistic(np.stack(fitted["sums"]), fitted["label"].to_numpy(np.float64))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs`` by its whole text.

    Null or empty texts and texts without letters get the score of no evidence.
    Null doc_ids and repeated rows stay; other columns are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return (base.mapInPandas(_scored_ids(model), "doc_id long, score double"))


def _scored_ids(model):
    scored = _scored(model, ["doc_id"])

    def run(batches):
        for out in scored(batches):
            yield out[["doc_id", "score"]].astype({"doc_id": "Int64"})
    return run


def toxicity_column(text: Column, model: ToxicityModel) -> Column:
    """The score as a column expression, so that all columns of a table stay; null text as empty."""
    scored = _scored(model, [])

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return next(scored(iter([pd.DataFrame({"text": texts.reset_index(drop=True)})])))["score"]

    return score(text)


def toxic_spans(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, score and ``spans``: [start, end) code points and marginal of each run of toxic tokens.

    A token is toxic when its marginal is at least ``threshold``; p is the largest of its run. The
    score is that of :func:`score_toxicity`. Null and empty texts and texts without
    letters have no spans; null doc_ids and repeated rows stay; other columns are not read.
    """
    def run(batches):
        for pdf in batches:
            rows = []
            for at, t in _token_chunks(pdf["text"]):
                p = model.marginals(model.token_inputs(t), t.doc)
                score = model.score(model.doc_sums(t, p, len(t.count)))
                for d in range(len(t.count)):
                    ids = np.flatnonzero(p[t.first[d]:t.first[d] + t.count[d]] >= threshold) + t.first[d]
                    spans = []
                    if len(ids):
                        data = _lowered(pdf["text"].iat[at + d]).encode("utf-8", "surrogatepass")
                        base = int(t.text_start[d])
                        chars = np.cumsum(np.concatenate(([0], (np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
                        for run_ids in np.split(ids, np.flatnonzero(np.diff(ids) > 1) + 1):
                            a, b = t.start[run_ids[0]] - base, t.end[run_ids[-1]] - base
                            spans.append((int(chars[a]), int(chars[b]), float(p[run_ids].max())))
                    rows.append((pdf["doc_id"].iat[at + d], float(score[d]), spans))
            yield pd.DataFrame(rows, columns=["doc_id", "score", "spans"]).astype({"doc_id": "Int64"})

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return base.mapInPandas(run, "doc_id long, score double, spans array<struct<start: int, end: int, p: double>>")
