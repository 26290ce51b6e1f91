import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctrail.llm.toxicity import Tokens, ToxicityModel, messages, score_toxicity, toxic_spans, train_toxicity

BAD = ["vile", "rotten", "scumbag"]


@pytest.fixture(scope="module")
def trained(spark):
    rnd = random.Random(1)
    vocab = [a + b + c for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    docs, labels = [], []
    for i in range(500):
        words = rnd.choices(vocab, k=rnd.randint(5, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(BAD).title())
        docs.append((i, " ".join(words) + ".", "x", 3))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(docs, "doc_id long, text string, score string, label int")
    return df, dict(labels), train_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int"), min_texts=3)


def test_messages_match_enumeration():
    rnd = np.random.default_rng(2)
    u, moves = rnd.normal(size=6).astype(np.float32) * 2, rnd.normal(size=(2, 2))
    f, b = messages(u, np.zeros(6, int), moves, 1e-7)
    total, on = 0.0, np.zeros(6)
    for s in itertools.product((0, 1), repeat=6):
        e = np.exp(sum(u[i] for i in range(6) if s[i]) + sum(moves[s[i], s[i + 1]] for i in range(5)))
        total += e
        on += e * np.array(s)
    assert np.allclose(1 / (1 + np.exp(-(u + f + b))), on / total, atol=1e-4)


def test_held_out_accuracy(trained):
    df, labels, model = trained
    rows = score_toxicity(df, model).withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 3 == 1).collect()
    held = [r for r in rows if r["held"]]
    assert len(rows) == 500 and len(held) > 100
    assert sum((r["score"] >= 0.7) == bool(labels[r["doc_id"]]) for r in held) / len(held) > 0.97


def test_spans(trained, spark):
    _, _, model = trained
    text = "été bal: Vile SCUMBAG dan"
    row = toxic_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[s.start:s.end] for s in row.spans] == ["Vile SCUMBAG"]


def test_edges(trained, spark):
    _, _, model = trained
    rows = [(1, None), (2, ""), (3, "?? 12"), (None, "vile rotten vile"), (5, "bal " * 200_000), (5, "bal"), (5, "bal")]
    got = score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    score = {(r["doc_id"]): r["score"] for r in got}
    assert score[1] == score[2] == score[3] < 0.7 <= score[None]


def test_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = train_toxicity(docs, labels)
    assert score_toxicity(docs, model).collect() == []
    one = score_toxicity(spark.createDataFrame([(1, "vile")], "doc_id long, text string"), model).first()
    assert one["score"] < 0.01


def test_every_kept_feature_has_its_own_odds():
    words = [f"{a}{b}{c}q" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd"]
    t = Tokens([" ".join(words).encode()])
    keys = np.unique(t.features[0])
    odds = np.arange(1, len(keys) + 1, dtype=np.float32)
    # all keys but the odd ones are known, however their bits agree
    model = ToxicityModel(keys[::2], odds[::2], np.zeros(6), np.zeros((2, 2)), np.zeros(4))
    want = dict(zip(keys[::2].tolist(), odds[::2].tolist(), strict=True))
    assert model.token_inputs(t)[:, 1].tolist() == [want.get(h, 0) for h in t.features[0].tolist()]


def test_scores_follow_from_exact_marginals(trained):
    _, _, model = trained
    rnd = random.Random(3)
    for _ in range(20):
        words = rnd.choices(["bal", "dan", "vile", "rotten", "scumbag", "fit"], k=rnd.randint(1, 8))
        t = Tokens([" ".join(words).encode()])
        u = model.token_inputs(t) @ model.weights
        total, on = 0.0, np.zeros(len(words))
        for s in itertools.product((0, 1), repeat=len(words)):
            e = np.exp(sum(u[i] for i in range(len(s)) if s[i]) + sum(model.moves[a, b] for a, b in itertools.pairwise(s)))
            total += e
            on += e * np.array(s)
        p = on / total
        sure = p[p >= 0.5].sum()
        x = np.array([1, np.log1p(sure), np.log(sure / (len(words) + 20) + 1e-3), max(p.max(), 0) if (p >= 0.5).any() else 0])
        want = 1 / (1 + np.exp(-x @ model.doc))
        got = model.score(model.doc_sums(t, model.marginals(model.token_inputs(t), t.doc), 1))[0]
        if abs(p - 0.5).min() > 1e-3:
            assert abs(got - want) < 1e-3
