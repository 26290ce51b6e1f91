import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from acctrail.llm import queries
from acctrail.llm.consistent_parse import (_pieces, document_fingerprints, edited, fingerprints, likeness, parse_round,
                                           phrase_names)

MASK = (1 << 64) - 1
SCHEMA = "doc_id long, text string"


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_round(names, round_):
    """One round for one text, written out symbol by symbol."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    s = [x if n == 1 else mix((x * 0x94D049BB133111EB + n * 0x9E3779B97F4A7C15) & MASK) for x, n in runs]
    label = list(s)
    for _ in range(4):
        tossed = []
        for i, x in enumerate(label):
            differ = (x ^ label[i - 1]) if i else 1
            place = ((differ or 1) & -(differ or 1)).bit_length() - 1
            tossed.append(2 * place + ((x >> place) & 1))
        label = tossed
    cuts = [0] + [i for i in range(2, len(s)) if label[i] > label[i - 1] and (i + 1 == len(s) or label[i] > label[i + 1])]
    phrases = [s[a:b] for a, b in zip(cuts, cuts[1:] + [len(s)], strict=True)]
    return [mix((sum(mix((x + i * 0x9E3779B97F4A7C15) & MASK) for i, x in enumerate(p)) + round_) & MASK) for p in phrases], label


def plain_names(text):
    names, out = [ord(c) for c in text], []
    while not out or len(out[-1]) > 1:
        names, _ = plain_round(names, len(out) + 1)
        out.append(names)
    return out


def plain_fingerprint(text, level=3, size=64):
    if not text:
        return "0" * 16 + ":"
    rounds = plain_names(text)
    found = {x >> 24 for r in rounds[level - 1:] for x in r} | {rounds[-1][0] >> 24}
    return f"{rounds[-1][0]:016x}:" + "".join(f"{x:010x}" for x in sorted(found)[:size])


def some_texts(n=60, seed=1):
    rnd = random.Random(seed)
    fixed = ["", "a", "aa", "ab", "aba", "a" * 1000, "ab" * 300, "abc" * 99 + "é😀", "\u0000x", "  "]
    return fixed + ["".join(rnd.choices("abc déñ😀\n", k=rnd.randint(1, 400))) for _ in range(n)]


def test_rounds_equal_the_plain_form():
    texts = some_texts()
    got = {}
    for round_, text, names in phrase_names(texts):
        for i, x in zip(text.tolist(), names.tolist(), strict=True):
            got.setdefault(i, {}).setdefault(round_, []).append(x)
    for i, t in enumerate(texts):
        assert list(got.get(i, {}).values()) == (plain_names(t) if t else [])
    assert fingerprints(texts) == [plain_fingerprint(t) for t in texts]
    assert fingerprints([]) == [] and fingerprints(["", ""]) == ["0" * 16 + ":"] * 2


def test_labels_are_six_and_neighbours_differ():
    rnd = random.Random(2)
    names = [rnd.getrandbits(64) for _ in range(3000)]
    _, label = plain_round(names, 1)
    assert set(label) <= set(range(6))
    assert all(a != b for a, b in zip(label, label[1:], strict=False))


def test_every_round_shrinks():
    for n in range(2, 40):
        names = np.arange(n, dtype=np.uint64)
        made, _ = parse_round(names, np.array([0]), 1)
        assert len(made) < n


def test_equal_substrings_share_interior_phrases_at_any_offset():
    rnd = random.Random(3)
    word = lambda k: "".join(rnd.choices("abcdefgh ijkl.", k=k))
    shared = word(4000)
    rounds = []
    for pad in (0, 1, 2, 7, 500):
        text = word(pad) + shared + word(300)
        rounds.append(plain_names(text)[:4])
    for r in range(4):
        base = rounds[0][r]
        inner = set(base[8:int(len(base) * 4000 / 4300) - 8])
        for other in rounds[1:]:
            assert inner <= set(other[r])


def test_likeness_is_exact_for_small_sets_and_close_for_large():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefghijklmno", k=rnd.randint(2, 9))) for _ in range(900)]

    def full(t):
        return {x >> 24 for r in plain_names(t)[2:] for x in r}

    short, long = " ".join(words[:40]), " ".join(words)
    for text in (short, long):
        changed = edited(text, "zz yy xx " * 900)
        a, b = full(text), full(changed)
        got = likeness(*fingerprints([text, changed]))
        assert abs(got - len(a & b) / len(a | b)) < (1e-12 if text is short else 0.2)
    assert likeness(*fingerprints(["", "x"])) == 0 and likeness(*fingerprints(["", ""])) == 1
    assert likeness(*fingerprints([short, long[::-1]])) < 0.05


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), np.int64(np.uint64(xxhash.xxh64_intdigest(r[1].encode(), seed=42)).view(np.int64))))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        e = t[:len(t) - len(t) // 3] + u[:len(t) // 3]
        f, g, n = (plain_fingerprint(x) for x in (t, e, u))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, round(likeness(f, g), 9), round(likeness(f, n), 9)))
    return sorted(out, key=str)


def got(df):
    return sorted((( *r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=str)


def test_query_rows(spark):
    texts = some_texts(80, 5)
    rows = [(3 * i - 50, t) for i, t in enumerate(texts)]
    rows += [(None, "no id"), (None, None), (7, None), (7, "tie one"), (7, "tie two"), (7, "tie two"), rows[20], rows[20]]
    random.Random(6).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "n_chars", "part", "kind", "fingerprint", "salt", "following"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(document_fingerprints(df)) == brute(rows)


def test_one_two_and_no_rows(spark):
    for rows in ([(1, "alone and its own successor")], [(1, "first of two texts"), (2, "second, longer text of the two")], []):
        assert got(document_fingerprints(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_text_keys(spark):
    rows = [(f"k{i}", t) for i, t in enumerate(some_texts(5))]
    found = document_fingerprints(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted(r.doc_id for r in found) == sorted(k for k, _ in rows)


def test_pieces_keep_all_rows():
    rows = [(i, "x" * (i % 7)) for i in range(100)]
    assert [r for p in _pieces(rows, 10) for r in p] == rows


def test_very_long_text():
    text = "".join(random.Random(7).choices("abcdefg hij", k=2_000_000))
    one, two = fingerprints([text, text[:-5]])
    assert len(one) == 17 + 64 * 10 and likeness(one, two) > 0.9


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    assert got(document_fingerprints(spark.createDataFrame(short, SCHEMA))) == brute(short)
    assert queries.op11_fingerprints(spark, sf).count() == len(rows)
