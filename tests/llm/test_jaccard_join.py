import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from acctrail.llm import jaccard_join
from acctrail.llm.jaccard_join import jaccard_components

SCHEMA = "doc_id long, text string"


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute(rows, k, t):
    sets = [shingles(x, k) for _, x in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                o = len(sets[i] & sets[j])
                if t.denominator * o >= t.numerator * len(sets[i] | sets[j]):
                    parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def check(spark, rows, k, t):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("root", F.lit(1)).withColumn("cls", F.lit("c"))
    got = [tuple(r) for r in jaccard_components(df.repartition(4), k, t).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, k, t), key=key)


def near_rows(seed, count, lengths):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(300)]
    rows = []
    while len(rows) < count:
        text = rnd.choices(vocab, k=rnd.choice(lengths))
        for _ in range(rnd.choice([1, 1, 2, 6])):
            t = list(text)
            for _ in range(rnd.randint(0, max(1, len(t) // 25))):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                t = t[rnd.randint(0, 2):]
            rows.append((len(rows) * 13 % 1009, " ".join(t).title() if rnd.random() < 0.2 else " ".join(t)))
    return rows


def test_contract_parameters(spark):
    check(spark, near_rows(5, 220, [2, 3, 11, 12, 13, 30, 60, 150, 600]), 3, Fraction(90, 100))


def test_default_parameters(spark):
    check(spark, near_rows(6, 160, [5, 9, 20, 45, 120, 900]), 5, Fraction(80, 100))


def test_edges(spark):
    t = " ".join(f"x{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "One"), (6, "one two"), (7, t), (7, t), (7, "other words here"),
            (8, t + " y"), (None, t + " z"), (None, "alone with null id"), (None, None), (9, "é É x"), (10, "é é x")]
    check(spark, rows, 3, Fraction(90, 100))


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 600)
    check(spark, near_rows(8, 60, [60]) + [(2000 + i, " ".join([f"q{j}" for j in range(80)] + [f"t{i}"])) for i in range(60)],
          3, Fraction(90, 100))


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql_equals_brute_force():
    import duckdb
    import pandas as pd

    from acctrail.llm.queries import oracle_sql
    t = " ".join(f"x{i}" for i in range(40))
    edges = [(3001, None), (3002, ""), (3003, " \n "), (3004, "one"), (3005, "One"), (3006, "one two"), (3007, t), (3007, t),
             (3008, t + " y"), (None, t + " z"), (None, "alone with null id"), (None, None), (3009, "é É x"), (3010, "é é x")]
    for rows in (near_rows(5, 220, [2, 3, 11, 12, 13, 30, 60, 150, 600]) + edges, []):
        documents = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})  # noqa: F841
        got = duckdb.sql(oracle_sql()["op6_ngram_jaccard"]).fetchall()
        assert sorted(got, key=key) == sorted(brute(rows, 3, Fraction(90, 100)), key=key)


def test_deep_tree_equals_brute_force(spark, monkeypatch):
    """Small leaves and a small fan give a tree of many levels, whose descent loses no link."""
    monkeypatch.setattr(jaccard_join, "LEAF_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "FAN", 2)
    check(spark, near_rows(9, 150, [11, 12, 13, 30, 60, 150]), 3, Fraction(90, 100))


def test_parent_boxes_hold_their_children_and_the_descent_prunes(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(40):
        n = 100 + 50 * (i // 4)
        c = [rnd.randint(0, 6) for _ in range(64)]
        rows.append(((i // 10 << 24) + i % 10 + 1, n, n + 9, c, [x + rnd.randint(0, 2) for x in c]))
    leaves = spark.createDataFrame(rows, "leaf long, n_lo long, n_hi long, lo array<int>, hi array<int>")
    levels = [{r.node: r for r in level.collect()} for level in jaccard_join._tree(leaves)]
    assert len(levels[0]) == 40 and len(levels[-1]) == 1 and len(levels) == 3
    for below, above in zip(levels, levels[1:]):
        for node, r in below.items():
            p = above[node // jaccard_join.FAN]
            assert p.n_lo <= r.n_lo and p.n_hi >= r.n_hi
            assert all(x <= y for x, y in zip(p.lo, r.lo)) and all(x >= y for x, y in zip(p.hi, r.hi))
    num, den = 9, 10

    def may(a, b):
        least = sum(min(x, y) for x, y in zip(a[4], b[4]))
        gap = sum(max(x - y, u - v, 0) for x, y, u, v in zip(a[3], b[4], b[3], a[4]))
        return (a[1] * num <= b[2] * den and b[1] * num <= a[2] * den and least * (den + num) >= (a[1] + b[1]) * num
                and gap * (den + num) <= (a[2] + b[2]) * (den - num))

    want = {(a[0], b[0]) for a in rows for b in rows if a[0] <= b[0] and may(a, b)}
    got = [tuple(r) for r in jaccard_join._leaf_pairs(leaves, num, den).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < 40 * 41 // 2


def _sets_near(rnd, x, y, both):
    """Sorted hashes of two sets of sizes x and y with ``both`` in common."""
    pool = np.array([rnd.getrandbits(64) for _ in range(x + y - both)], np.uint64)
    return np.sort(pool[:x]), np.sort(np.concatenate([pool[:both], pool[x:]]))


def test_linked_sets_share_a_token_with_any_list_of_common_shingles():
    rnd = random.Random(3)
    for num, den in ((8, 10), (9, 10), (1, 2)):
        least = -(-num // (den - num))
        for _ in range(1500):
            x = rnd.choice([rnd.randint(least, 40), rnd.choice([2, 4, 8]) * 16 + rnd.randint(-2, 2), rnd.randint(100, 700)])
            y = rnd.randint(x, x * den // num)
            a, b = _sets_near(rnd, x, y, -(-num * (x + y) // (den + num)))
            common = np.sort(np.array(rnd.sample(a.tolist(), rnd.choice([0, x // 2, x])), np.uint64))
            sides = [np.frombuffer(t, np.uint64) for t in jaccard_join._tokens(
                np.concatenate([a, b]), np.array([0, x, x + y]), num, den, common)]
            assert len(np.intersect1d(*sides)), (num, den, x, y)


def test_tokens_of_rare_shingles_come_first_and_unrelated_sets_share_none():
    rnd = random.Random(4)
    passage, n = np.array([rnd.getrandbits(64) for _ in range(60)], np.uint64), 200
    sets = [np.sort(np.concatenate([passage, np.array([rnd.getrandbits(64) for _ in range(n - 60)], np.uint64)])) for _ in range(300)]
    offsets = np.arange(0, n * 300 + 1, n)
    found = [jaccard_join._tokens(np.concatenate(sets), offsets, 8, 10, c) for c in (np.zeros(0, np.uint64), np.sort(passage))]
    again = [len(t) - len(np.unique(t)) for t in (np.frombuffer(b"".join(f), np.uint64) for f in found)]
    assert again[1] == 0 < again[0]


def test_few_pairs_of_leaves_for_texts_without_links(spark, monkeypatch):
    """Boxes of unrelated texts of one length all overlap; only regions keep their pairs from growing with the square."""
    monkeypatch.setattr(jaccard_join, "LEAF_ROWS", 2)
    monkeypatch.setattr(jaccard_join, "FAN", 4)
    rnd, counts, pairs_of = random.Random(7), [], jaccard_join._leaf_pairs

    def counted(leaves, num, den):
        pairs = pairs_of(leaves, num, den)
        counts.append((leaves.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "_leaf_pairs", counted)
    rows = [(i, " ".join(f"w{rnd.randrange(5000)}" for _ in range(100))) for i in range(120)]
    rows += [(200 + i, f"{text} end") for i, text in rows[:20]]
    check(spark, rows, 5, Fraction(80, 100))
    (leaves, pairs), = counts
    assert 0 < leaves and pairs <= 4 * 140


def test_leaves_of_other_regions_are_no_pairs(spark):
    rows = [(i + 1, i // 4 * 10, i // 4 * 10 + 9 + i % 4 // 3, 100, 109, [2] * 64, [3] * 64) for i in range(40)]
    leaves = spark.createDataFrame(rows, "leaf long, region_lo long, region_hi long, n_lo long, n_hi long, lo array<int>, hi array<int>")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] <= b[0] and a[1] <= b[2] and b[1] <= a[2]}
    got = [tuple(r) for r in jaccard_join._leaf_pairs(leaves, 9, 10).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) < 160


def test_op6_tokens_join_near_copies_only():
    """3 words, 0.90: of 200 unrelated texts of one length, those with a near copy share a token with it, the others with none."""
    rnd = random.Random(11)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(150)) for _ in range(200)]
    texts += [f"{t} end" for t in texts[:20]]
    gram, offsets = jaccard_join.shingle_sets([t.encode() for t in texts], 3)
    tokens = [set(np.frombuffer(t, np.uint64).tolist()) for t in jaccard_join._tokens(gram, offsets, 9, 10, np.zeros(0, np.uint64))]
    assert {(i, j) for j in range(220) for i in range(j) if tokens[i] & tokens[j]} == {(i, 200 + i) for i in range(20)}
