import gc
import random
import weakref

from pyspark.sql import functions as F

from acctrail.llm import decontaminate
from acctrail.llm.decontaminate import _distance, best_run, drop_contaminated, find_passages

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def test_best_run_is_exact():
    rnd = random.Random(5)
    for _ in range(300):
        p, t = rnd.choices("abcd", k=rnd.randint(1, 9)), rnd.choices("abcd", k=rnd.randint(0, 14))
        want = min([_distance(p, t[a:b]) for a in range(len(t) + 1) for b in range(a, len(t) + 1)])
        d, end = best_run(p, t)
        assert d == want and (d == len(p) or min(_distance(p, t[a:end]) for a in range(end + 1)) == d)


def brute(docs, items):
    out = set()
    for d, text in docs:
        t = (text or "").lower().replace(".", " ").split()
        for k, item in items:
            p = (item or "").lower().replace(".", " ").split()
            if len(p) >= 6 and best_run(p, t)[0] <= int(0.2 * len(p)):
                out.add((d, k))
    return out


def edited(rnd, words, n, vocab):
    w = list(words)
    for _ in range(n):
        at = rnd.randrange(len(w))
        op = rnd.randrange(3)
        if op == 0:
            w[at] = rnd.choice(vocab)
        elif op == 1:
            del w[at]
        else:
            w.insert(at, rnd.choice(vocab))
    return w


def test_recall_and_precision(spark):
    rnd = random.Random(7)
    vocab = [f"v{i}" for i in range(200)]
    items = [(k, " ".join(rnd.choices(vocab, k=rnd.randint(6, 60))).capitalize() + ".") for k in range(40)] + [(99, "too short"), (98, None)]
    docs = []
    for d in range(300):
        words = rnd.choices(vocab, k=rnd.randint(0, 120))
        if d % 2:
            p = rnd.choice(items[:40])[1].lower().strip(".").split()
            at = rnd.randint(0, len(words))
            words[at:at] = edited(rnd, p, rnd.randint(0, len(p) // 5), vocab)
        docs.append((d, " ".join(words)))
    df = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit(-1))
    bench = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(-2))
    rows = find_passages(df, bench).collect()
    got, want = {(r.doc_id, r.item_id) for r in rows}, brute(docs, items)
    assert got <= want and len(got) >= 0.97 * len(want)
    text, by = dict(docs), dict(items)
    for r in rows:
        run = text[r.doc_id].split()[r.first_word:r.first_word + r.n_words]
        assert _distance(by[r.item_id].lower().strip(".").split(), run) == r.distance


def test_recall_does_not_fall_with_length(spark):
    rnd = random.Random(13)
    vocab = [f"v{i}" for i in range(3000)]
    items, docs = {}, {}
    for size in (20, 40, 41, 150, 300, 600, 1000):
        for uneven in (False, True):
            for _ in range(15):
                k = len(items)
                p = items[k] = rnd.choices(vocab, k=size)
                part = size // 2 if uneven else size
                docs[k] = rnd.choices(vocab, k=30) + edited(rnd, p[:part], size // 5, vocab) + p[part:] + rnd.choices(vocab, k=30)
    bench = spark.createDataFrame([(k, " ".join(p)) for k, p in items.items()], ITEMS)
    rows = find_passages(spark.createDataFrame([(k, " ".join(t)) for k, t in docs.items()], DOCS), bench).collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows) and all(r.doc_id == r.item_id for r in rows)
    for size in {len(p) for p in items.values()}:
        same = [k for k, p in items.items() if len(p) == size]
        assert sum(k in found for k in same) >= 0.95 * len(same), size
    for k, r in found.items():
        d = best_run(items[k], docs[k])[0]
        assert r.distance == d <= len(items[k]) // 5
        if len(items[k]) <= 150:
            assert _distance(items[k], docs[k][r.first_word:r.first_word + r.n_words]) == d


def test_short_items_are_matched_exactly(spark):
    rnd = random.Random(17)
    vocab = [f"v{i}" for i in range(12)]
    items = {k: rnd.choices(vocab, k=1 + k % 5) for k in range(60)}
    docs = {d: rnd.choices(vocab, k=rnd.randint(0, 25)) for d in range(150)}
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in docs.items()], DOCS)
    for edits in (0.2, 0.1):
        rows = find_passages(frame, spark.createDataFrame([(k, " ".join(p)) for k, p in items.items()], ITEMS), edits).collect()
        best = {(d, k): best_run(p, t)[0] for d, t in docs.items() for k, p in items.items()}
        assert sorted((r.doc_id, r.item_id, r.distance) for r in rows) == sorted(
            (d, k, n) for (d, k), n in best.items() if n <= int(edits * len(items[k])))
        for r in rows:
            assert _distance(items[r.item_id], docs[r.doc_id][r.first_word:r.first_word + r.n_words]) == r.distance


def test_unicode_words(spark):
    han, thai = "敏捷的棕色狐狸跳過懶狗然後跑進黑暗的森林裡", "สุนัขจิ้งจอกสีน้ำตาลกระโดดข้ามสุนัขขี้เกียจ"
    plain = "it's the well known story of one very old fox's long night"
    bench = spark.createDataFrame([(1, han), (2, thai), (3, plain), (4, "नमस्ते दुनिया"), (5, "狐狸")], ITEMS)
    docs = [(1, "x" + han[:7] + "紅" + han[8:] + "y"), (2, "ก" + thai + "a"),
            (3, plain.replace("'", "\u2019").replace(" ", "\u00a0").replace("very\u00a0", "\u201cvery\u201d\u2014").upper()),
            (4, "«नमस्ते\u3000दुनिया»"), (5, "नमस्त दुनिया, 狐 狗"), (6, han[::-1])]
    rows = find_passages(spark.createDataFrame(docs, DOCS), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in rows) == [(1, 1, 1), (1, 5, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0)]


def test_edges(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, None), (2, ""), (3, "?"), (4, item.upper()), (4, item.upper()), (None, "x " * 50_000 + item), (5, item[:20])]
    bench = spark.createDataFrame([(1, item), (1, item), (2, ""), (None, item)], ITEMS)
    rows = find_passages(spark.createDataFrame(docs, DOCS), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0, r.distance) for r in rows) == sorted(
        [(d, k, 0) for d in (4, 4, 0) for k in (1, 1, 0)])


def test_empty(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c d e f g")], ITEMS)
    assert find_passages(none, some).collect() == []
    assert find_passages(spark.createDataFrame([(1, "a b c d e f g")], DOCS), spark.createDataFrame([], ITEMS)).collect() == []


def test_driver_holds_one_block(spark, monkeypatch):
    rnd = random.Random(23)
    items = [(k, " ".join(rnd.choices([f"v{i}" for i in range(300)], k=20))) for k in range(5)]
    docs = spark.createDataFrame([(d, f"a b {items[d][1]} c" if d < 5 else None if d == 5 else "x y") for d in range(7)], DOCS)
    bench = spark.createDataFrame(items, ITEMS)
    made, alive = [], []

    def index(*args, real=decontaminate.Index):
        gc.collect()
        alive.append(sum(r() is not None for r in made))
        out = real(*args)
        made.append(weakref.ref(out))
        return out

    monkeypatch.setattr(decontaminate, "Index", index)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    found = find_passages(docs, bench)
    assert len(alive) == 5 and max(alive) == 0
    assert sorted(tuple(r) for r in found.collect()) == [(k, k, 0, 2, 20) for k in range(5)]
    del found
    kept = drop_contaminated(docs, bench)
    assert len(alive) == 10 and max(alive) <= 1  # a row filter lives until the next is set
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6]
