import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acctrail.llm import pii
from acctrail.llm.pii import KINDS, Examples, Field, PiiModel, _luhn, find_pii, fit_field, masked_column, rule_spans, train_pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and _luhn(d),
                  10 <= len(d) <= 15][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.@+-() ab%é\n", max_size=60))
def test_rules_match_the_plain_patterns(text):
    assert rule_spans(text) == plain(text)


def card(rnd):
    d = "".join(rnd.choices("0123456789", k=15))
    return next(d + c for c in "0123456789" if _luhn(d + c))


def make(rnd, i):
    words = rnd.choices(["alpha", "beta", "gamma", "delta", "1984", "room 12"], k=30)
    pii = [f"u{i}@mail.example.com", f"10.{i % 256}.3.4", card(rnd), f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"]
    for x in rnd.sample(pii, rnd.randint(0, 3)):
        words.insert(rnd.randrange(len(words)), x)
    return " ".join(words)


@pytest.fixture(scope="module")
def trained(spark):
    rnd = random.Random(2)
    rows = [(i, make(rnd, i)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    return df, dict(rows), train_pii(df)


def test_base_stays_and_clean_tokens_stay_clean(trained):
    df, texts, model = trained
    for r in find_pii(df, model).collect():
        want = [(KINDS[k], a, b) for a, k, b in plain(texts[r.doc_id])]
        assert [tuple(s) for s in r.base] == want
        assert [tuple(s) for s in r.spans if tuple(s) in set(want)] == want
        for s in r.spans:
            assert texts[r.doc_id][s.start:s.end] not in ("1984", "12")


def test_repeats_share_labels():
    texts = ["call +1 (555) 555-1234 now", "x 5555551234 y 5555551234"]
    model = PiiModel(np.zeros((1 << 14, 5)), np.zeros((3, 5, 5)))
    field = Field(texts)
    model.pair[2] = 4 * np.eye(5)
    first = min(i for i, d in enumerate(field.doc) if d == 1)
    apart = Field(["x 5555551234 y 99 z 5555551234"])
    model.unary[apart.feats[0, 4], 4] = 3
    p, _ = model.beliefs(apart)
    assert first >= 0 and 2 in apart.kind and p[2, 4] > 0.5 > p[1, 4]


def test_trees_are_exact():
    rnd = np.random.default_rng(0)
    field = Field(["a1 b2 c3"])
    model = PiiModel(rnd.normal(size=(1 << 14, 5)), rnd.normal(size=(3, 5, 5)))
    p, _ = model.beliefs(field, 60)
    u = model.unary[field.feats].sum(1)
    z = np.exp(u[0][:, None, None] + u[1][None, :, None] + u[2] + model.pair[0][:, :, None] + model.pair[0][None])
    assert np.allclose(p[1], z.sum((0, 2)) / z.sum(), atol=1e-3)


def test_all_repeats_hear_of_the_clear_one():
    words = [x for i in range(30) for x in ("5555551234", "x", f"{i}a", "y")]
    field = Field([" ".join([*words, "tel", "5555551234"]), "5 6"])
    model = PiiModel(np.zeros((1 << 14, 5)), np.zeros((3, 5, 5)))
    model.pair[2] = 4 * np.eye(5)
    model.unary[field.feats[60, 4], 4] = 8
    p, _ = model.beliefs(field)
    assert (p[0:61:2, 4] > 0.5).all() and (p[1:60:2, 4] < 0.5).all()


def test_long_chains_are_exact():
    rnd = np.random.default_rng(1)
    field = Field([" ".join(f"{'abcdefgh'[i % 8]}{i}" for i in range(60)), "c3 d4"])
    model = PiiModel(np.zeros((1 << 14, 5)), np.zeros((3, 5, 5)))
    model.pair[0] = 5 * np.eye(5) + 0.1 * rnd.normal(size=(5, 5))
    model.unary[field.feats[0, 4], 2] = 20
    p, _ = model.beliefs(field)
    u, psi = np.exp(model.unary[field.feats].sum(1)), np.exp(model.pair[0])
    there, back = [np.ones(5)], [np.ones(5)]
    for i in range(59):
        there.append((x := (there[-1] * u[i]) @ psi) / x.sum())
        back.append((x := psi @ (back[-1] * u[59 - i])) / x.sum())
    want = np.array(there) * u[:60] * np.array(back[::-1])
    assert np.allclose(p[:60], want / want.sum(1, keepdims=True), atol=0.01)


def test_edges(trained, spark):
    _, _, model = trained
    rows = [(1, None), (2, ""), (None, "a@b.co"), (3, "9" * 20_000 + "." + "a" * 20_000 + "@"), (4, "a@b.co"), (4, "a@b.co")]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sorted((r.doc_id or 0, len(r.base)) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1)]


def test_mask(trained, spark):
    _, _, model = trained
    df = spark.createDataFrame([("é a@b.co, 10.0.0.1 +1 (555) 555-1234.",), (None,), ("",)], "text string")
    got = [r[0] for r in df.select(masked_column(F.col("text"), model)).collect()]
    assert got == ["é <EMAIL>, <IP> <PHONE>.", None, ""]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert find_pii(df, train_pii(df)).collect() == []
    assert fit_field([]).unary[0, 0] == 1


def test_features_see_the_whole_token():
    # equal for 80 characters, then a digit or a letter
    a, b = Field(["x1" + "-" * 80 + "5"]), Field(["x1" + "-" * 80 + "k"])
    assert (a.feats != b.feats).any()


def test_similar_tokens_are_linked():
    field = Field(["AB-1234-77 then AB-1234-99 but 17/05/2021 and XY-9874-77"])
    links = set(zip(field.left.tolist(), field.right.tolist(), field.kind.tolist(), strict=True))
    assert {x for x in links if x[2] == 3} == {(0, 3, 3)}  # 0 and 1 are neighbours, 3 shares the end of 0
    model = PiiModel(np.zeros((1 << 14, 5)), np.zeros((4, 5, 5)))
    model.pair[3] = 4 * np.eye(5)
    model.unary[field.feats[0, 4], 3] = 8
    p, _ = model.beliefs(Field(["AB-1234-77 then 5 but 6 and XY-9874-77"]))
    assert p[3, 3] > 0.5


def test_unsettled_texts_fall_back_to_their_chain(monkeypatch):
    monkeypatch.setattr(pii, "MOST_ROUNDS", 3)
    rnd = np.random.default_rng(4)
    words = [f"w{i}" if i % 3 else "7777777" for i in range(40)]
    field = Field([" ".join(words)])
    model = PiiModel(rnd.normal(size=(1 << 14, 5)), rnd.normal(size=(4, 5, 5)))
    p, _ = model.beliefs(field)
    chain = Field([" ".join(words)])
    keep = chain.kind < 2
    chain.left, chain.right, chain.kind = chain.left[keep], chain.right[keep], chain.kind[keep]
    want, _ = model.beliefs(chain, 400)
    assert np.allclose(p, want, atol=1e-2)


def test_hidden_spans_keep_their_place():
    rnd = random.Random(5)
    lost = 0
    for i in range(300):
        text = make(rnd, i)
        shown, spans = pii._hidden(text)
        want = rule_spans(text)
        assert [k for _, k, _ in spans] == [k for _, k, _ in want]
        for (a, k, b), (c, _, d) in zip(want, spans, strict=True):
            assert shown[c:d] in (text[a:b], text[a + 1:b], text[a:b].split(".")[0])
        lost += shown != text
    assert 50 < lost < 300


def test_spans_beyond_the_rules_are_found():
    rnd = random.Random(6)
    texts = [f"{make(rnd, i)} call +1 (555) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)} today" for i in range(300)]
    model = fit_field(texts)
    plainly = [f"alpha beta call 1 (555) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)} today 1984" for _ in range(50)]
    _, added = pii._all_spans(plainly, model, 0.5)
    found = sum(any(KINDS[k] == "phone" for _, k, _ in x) for x in added)
    assert found >= 45 and not any(t[a:b] == "1984" for t, x in zip(plainly, added, strict=True) for a, _, b in x)


def test_texts_are_drawn_whole_within_the_bounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit_examples", lambda field, **_: seen.append(field))
    rows = [(i, " ".join(str(j) for j in range(50))) for i in range(20)] + [(99, "1 " * 500)]
    train_pii(spark.createDataFrame(rows, "doc_id long, text string"), node_limit=620, text_nodes=100)
    field, = seen
    assert np.bincount(field.doc).tolist() == [50] * 12
    assert set(np.unique(field.right - field.left)) == {1}
