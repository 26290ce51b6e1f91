import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from acctrail.llm.bpe import SQL_WORD_BYTES, Tokenizer, decode_ids, encode_texts, token_digests
from acctrail.llm.queries import rank_file


@pytest.fixture(scope="module")
def tok():
    return Tokenizer(*rank_file())


@pytest.fixture(scope="module")
def library(tok):
    enc = tiktoken.Encoding("own", pat_str=rank_file()[1], mergeable_ranks=tok.ranks, special_tokens={})
    return lambda t: np.array(enc.encode_ordinary(t), "<u4").tobytes()


TEXTS = ["", " ", "  ", "a", " a  b   c \n d\n e  \tf\u00a0 g  ", "it's we'll I'M 'd", "<|endoftext|>", "\x1c a \x85b", "\u3000x y",
         "Größe naïve façade 😀😀 12345 ½ ²", "=" * 700 + " " * 40, "aaaaaaaaaa" * 60, "tab\tnew\r\nline \x0b", " lead", "trail "]


def test_same_ids_as_the_library(tok, library):
    assert tok.encode(TEXTS) == [library(t) for t in TEXTS]
    assert tok.decode([library(t) for t in TEXTS]) == [t.encode() for t in TEXTS]


def test_random_text(tok, library):
    rnd = random.Random(1)
    alphabet = "abcdeéñ  \n\t.,!?'-_0123 😀ßÀ\u00a0\u2003"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 80))) for _ in range(1500)]
    assert tok.encode(texts) == [library(t) for t in texts]


def test_long_words_follow_the_same_rule(tok, library):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdetaon", k=SQL_WORD_BYTES + d)) for d in (-2, -1, 0, 1, 2, 900)]
    assert tok.encode(words) == [library(w) for w in words]
    assert [np.array(tok._long_word(w.encode()), "<u4").tobytes() for w in words] == [library(w) for w in words]


def test_query_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (99, None), (1, "a"), (1, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("z"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in token_digests(df, *rank_file()).collect())
    want = sorted((i is None, i or 0, len(library(t or "")) // 4, hashlib.sha256(library(t or "")).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert got == want


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(2, "héllo wörld", None)], "k int, text string, extra double")
    row = decode_ids(encode_texts(df, *rank_file()), *rank_file()).first()
    assert (row.k, row.text, row.extra, bytes(row.decoded).decode()) == (2, "héllo wörld", None, "héllo wörld")


def test_empty(spark):
    assert token_digests(spark.createDataFrame([], "doc_id long, text string"), *rank_file()).collect() == []


def test_caches_stay_within_their_bound(tok, library, monkeypatch):
    from acctrail.llm import bpe
    rnd = random.Random(5)
    own = Tokenizer(*rank_file())
    monkeypatch.setattr(bpe, "CACHE_BYTES", 200_000)
    for _ in range(6):
        texts = [" ".join("".join(rnd.choices("abcdeé,.", k=rnd.choice([3, 9, 400]))) for _ in range(300))]
        texts += ["字" * 3000 + " x " + "字" * 2999]
        assert own.encode(texts) == [library(t) for t in texts]
        assert all(len(n) <= bpe.CACHED_LENGTH for cache in (own.spaced, own.ids) for n in cache)
        assert own.held < 200_000 + 300 * len(texts[0])
        own._forget()
    assert own.held <= 200_000


def test_bytes_of_all_values_come_back(tok):
    ids = np.array([tok.ranks[bytes([b])] for b in range(256)], "<u4").tobytes()
    assert tok.decode([ids, b"", ids]) == [bytes(range(256)), b"", bytes(range(256))]
