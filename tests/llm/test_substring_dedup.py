import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from acctrail.llm import substring_dedup
from acctrail.llm.substring_dedup import dedup_substrings

SCHEMA = "doc_id long, text string"


def brute(rows, k=20):
    first = {}
    places = sorted((float("inf") if d is None else d, i, w) for d, t in rows
                    for w in [(t or "").encode().split()] for i in range(len(w) - k + 1))
    for d, i, w in places:
        first.setdefault(tuple(w[i:i + k]), (d, i))
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < (float("inf") if d is None else d, i):
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


def check(spark, rows, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("x")).withColumn("spans", F.lit(1))
    got = [tuple(r) for r in dedup_substrings(df.repartition(parts)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_random_passages(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    passages = [" ".join(rnd.choices(vocab, k=n)) for n in (19, 20, 21, 25, 40, 90, 200)]
    rows = []
    for d in range(150):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts.append(rnd.choice(passages) if rnd.random() < 0.5 else " ".join(rnd.choices(vocab, k=rnd.randint(1, 60))))
        rows.append((d * 7 % 151, "\n".join(parts)))
    check(spark, rows)


def test_edges(spark):
    rep = "a " * 70
    text = " ".join(f"x{i}" for i in range(33))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, rep), (5, rep), (6, text), (6, text), (7, text), (None, text),
            (8, "é ü " + text + "\x0b" + text), (9, "word"), (10, text[:40])]
    check(spark, rows)


def test_hot_passage_over_partitions(spark):
    hot = " ".join(f"h{i}" for i in range(30))
    rows = [(d, f"a{d} b{d} {hot} c{d}") for d in range(400)]
    check(spark, rows, 16)


def test_empty_table(spark):
    assert dedup_substrings(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("texts", [("p", "q")])
def test_one_id_two_texts_is_stable(spark, texts):
    body = " ".join(f"z{i}" for i in range(25))
    df = spark.createDataFrame([(1, body + " " + t) for t in texts], SCHEMA)
    a, b = (sorted(map(tuple, dedup_substrings(df.repartition(n)).collect())) for n in (1, 3))
    assert a == b and sum(r[2] for r in a) == 25


def test_spans_of_one_id_are_bounded_by_a_text(spark, monkeypatch):
    body = " ".join(f"z{i}" for i in range(25))
    df = spark.createDataFrame([(i % 2 or None, f"a{i} {body} b{i}") for i in range(60)], SCHEMA)
    assert sum(r.n_removed for r in dedup_substrings(df).collect()) == 59 * 25

    def sizes(k, variants):
        def run(batches):
            for pdf in batches:
                n = [0 if x is None else len(x) for x in pdf["spans"]]
                yield pd.DataFrame({"doc_id": pd.Series([0] * len(n), dtype="Int64"), "n_words": n, "n_removed": n, "kept_text": ""})
        return run

    monkeypatch.setattr(substring_dedup, "_cut", sizes)
    assert max(r.n_words for r in dedup_substrings(df).collect()) <= 25


def test_sql_equals_brute_force():
    import hashlib

    import duckdb

    from acctrail.llm.queries import oracle_sql
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    passages = [" ".join(rnd.choices(vocab, k=n)) for n in (19, 20, 21, 40, 90)]
    rows = [(d * 7 % 151, "\t".join(rnd.choice(passages) if rnd.random() < 0.5 else " ".join(rnd.choices(vocab, k=rnd.randint(1, 60)))
                                    for _ in range(rnd.randint(0, 5)))) for d in range(150)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "a " * 70), (904, passages[3]), (904, passages[3]), (None, passages[4])]
    for some in (rows, []):
        documents = pd.DataFrame(some, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})  # noqa: F841
        want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute(some)]
        assert sorted(duckdb.sql(oracle_sql()["op10_substring_dedup"]).fetchall(), key=key) == sorted(want, key=key)
