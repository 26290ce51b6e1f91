import numpy as np
from pyspark.sql import functions as F

from acctrail.llm.vector_dedup import dedup_vectors, plan_passes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def sound(r):
        v = r[1]
        return r[2] is not None and v and None not in v and np.isfinite(v).all() and np.any(v)

    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return [(r[0], links[i], low.get(find(i))) for i, r in enumerate(rows)]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit(1)).withColumn("vec", F.lit("v"))
    return [(r.vec_id, r.n_links, r.component_id) for r in dedup_vectors(df.repartition(3)).collect()]


def test_clusters(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for c in range(60):
        centre = rnd.normal(size=16)
        for _ in range(int(rnd.choice([1, 1, 2, 5, 40]))):
            noise = rnd.normal(size=16) * rnd.choice([0.0, 0.05, 0.12])
            rows.append((len(rows) * 31 % 9973, [float(x) for x in centre + noise], int(c % 3)))
    got, want = dict((r[0], r[1:]) for r in run(spark, rows)), dict((r[0], r[1:]) for r in brute(rows))
    found, true = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert all(got[k][0] <= want[k][0] for k in want) and found >= 0.99 * true
    assert sum(got[k][1] == want[k][1] for k in want) >= 0.99 * len(want)


def test_edges(spark):
    v = [0.1, 0.2, 0.3]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1), (5, [float("nan"), 1.0, 1.0], 1),
            (6, [float("inf"), 1.0, 1.0], 1), (7, v, None), (8, v, 1), (9, v, 1), (9, v, 1), (None, v, 1), (10, v, 2),
            (11, [0.2, 0.4, 0.6], 1), (12, [0.2, 0.4], 1), (13, [1e30, 2e30, 3e30], 2), (None, None, None)]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_one_large_group(spark):
    rnd = np.random.default_rng(2)
    centre = rnd.normal(size=8)
    rows = [(i, [float(x) for x in centre + rnd.normal(size=8) * 0.01], 1) for i in range(1300)]
    assert {r[1:] for r in run(spark, rows)} == {(1299, 0)}


def test_empty(spark):
    assert dedup_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_more_classes_mean_more_bits_and_passes():
    plans = [plan_passes(n, 0.98, 0.995) for n in (0, 1000, 10**6, 10**9)]
    assert plans == sorted(plans) and plans[0][1] >= 1


def test_double_vectors_stay_double(spark):
    # beyond single precision in size, and pairs that single precision would change
    rows = [(1, [1e300, 2e300, 0.0], 1), (2, [1e-300, 2e-300, 0.0], 1), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 1e-50, 0.0], 1),
            (5, [0.0, 1e-60, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in dedup_vectors(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5)}
