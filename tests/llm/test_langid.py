import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctrail.llm.langid import fit_ftrl, fit_temperature, identify_language, train_language_id

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ein"], "cc": ["é", "oux", "ment"]}


@pytest.fixture(scope="module")
def trained(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        lang = rnd.choice(sorted(SYLLABLES))
        words = ["".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(3, 40))]
        rows.append((i, " ".join(words), None if i % 50 == 7 else lang, lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    return df, train_language_id(df)


def test_held_out_accuracy(trained):
    df, model = trained
    assert model.languages == sorted(SYLLABLES)
    got = identify_language(df, model).join(df, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).collect()
    assert len(got) > 40 and sum(r["lang_pred"] == r["truth"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(trained, spark):
    _, model = trained
    rows = [(1, None), (2, ""), (3, "12 ?! _"), (None, "schungein"), (4, "kalo " * 100_000), (4, "kalo"), (4, "kalo")]
    got = identify_language(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert len(got) == 7 and [by[i] for i in (1, 2, 3)] == ["und"] * 3 and by[None] == "bb" and by[4] == "aa"


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = train_language_id(df)
    assert identify_language(df, model).collect() == []
    one = identify_language(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).first()
    assert (one["lang_pred"], one["score"]) == ("und", 0.0)


def test_l1_leaves_noise_at_zero():
    rows = [(np.array([y, 10 + i % 90]), np.array([1.0, 0.01]), y) for i in range(200) for y in (0, 1)]
    w, _ = fit_ftrl(rows, 2, l1=0.5)
    assert (w[0, 0] > 0 > w[0, 1]) and np.abs(w[10:100]).max() == 0


def test_temperature_flattens_overconfidence():
    logits = np.array([[8.0, 0.0]] * 100)
    assert fit_temperature(logits, np.array([0] * 70 + [1] * 30)) > 3


def test_letters_are_letters_and_ngrams_count_once(trained, spark):
    from acctrail.llm import langid
    _, model = trained
    rows = [(1, "²"), (2, "½ 12"), (3, "Ⅷ ①"), (4, "12 ñ")]
    got = {r["doc_id"]: r["lang_pred"] for r in identify_language(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[4] != "und"
    for n in (5, langid.PIECE - 1, langid.PIECE, langid.PIECE + 1, langid.PIECE + 2, 2 * langid.PIECE + 7):
        _, counts = langid._counts("a" * n)
        assert counts.sum() == n + (n - 1) + (n - 2)
