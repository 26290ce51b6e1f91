import hashlib
import json
import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acctrail.llm import queries
from acctrail.llm.token_alignment import Aligner, align_tokens, alignment_report, byte_alphabet, pair_counts

SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
A_FILE, B_FILE = queries.aligned_files()


def some_texts():
    rnd = random.Random(1)
    fixed = ["", " ", "a", "x y", "x  y z ", "a \x1c b \x85c d \u2003e", "The quick brown fox.", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "\x00 nul", "naïve façade ½ ①",
             "  two  spaces   three ", "tab\tnew\nline\r\n", "日本語テキスト 한국어", "😀😃 emoji 👩‍👩‍👧", "a" * 700, "=" * 333 + " x",
             " nbsp em", "é combining", "ﬁ ligature Ⅷ", "﻿bom", "\x85\x1c odd   ends", "1234567890 12 3"]
    return fixed + ["".join(rnd.choices("abcdeé ñ😀\n.,THE", k=rnd.randint(1, 300))) for _ in range(40)]


@pytest.fixture(scope="module")
def tokens():
    """(id, bytes) of both sides' tokens, by the libraries and plain rules."""
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    letters = byte_alphabet()
    entries = {i: t for t, i in json.load(open(A_FILE))["model"]["vocab"].items()}

    def run(text):
        if not text:
            return [], []
        ours = [(i, bytes(letters[c] for c in entries[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        theirs = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                  for i in b.encode(text)]
        data = (" " + text).encode()
        return (ours, theirs) if all(b"".join(t for _, t in x) == data for x in (ours, theirs)) else ([], [])
    return run


def spans(side):
    out, at = [], 0
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain(rows, tokens):
    """Groups by the common ends, links by comparing all pairs of a group."""
    per, counts = [], Counter()
    for i, text in rows:
        a, b = map(spans, tokens(text))
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, links, overlaps = [], [], 0
        for lo, hi in zip([0, *cuts], cuts, strict=False):
            ga, gb = ([s for s in x if lo < s[2] <= hi] for x in (a, b))
            groups.append(f"{','.join(str(s[0]) for s in ga)}|{','.join(str(s[0]) for s in gb)}")
            links += [(x[0], y[0]) for x in ga for y in gb if x[2] == y[2]]
            overlaps += sum(x[1] < y[2] and y[1] < x[2] for x in ga for y in gb)
        per.append((i, len(a), len(b), ";".join(groups), links, overlaps))
        counts.update(links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [(i, n_a, n_b, g.count("|"), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for i, n_a, n_b, g, links, _ in per], per, counts, most


def test_rows_counts_and_groups(spark, tokens):
    rows = [(i, t) for i, t in enumerate(some_texts())] + [(None, "no id"), (99, None), (3, "The quick brown fox."), (3, "The quick brown fox.")]
    want, per, counts, most = plain(rows, tokens)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("links", "n_a", "pair", "n", "best", "groups", "aligned text"):
        df = df.withColumn(name, F.lit("clash"))
    got = [tuple(r) for r in alignment_report(df, A_FILE, B_FILE).select(COLUMNS).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[1] == 0 for r in want} == {True, False}

    aligned = align_tokens(df, A_FILE, B_FILE)
    assert sorted((str(r.doc_id), r.groups, r.n_overlaps) for r in aligned.collect()) == sorted((str(p[0]), p[3], p[5]) for p in per)
    found = {(r.a_id, r.b_id): (r.n, r.best) for r in pair_counts(aligned, A_FILE, B_FILE).collect()}
    assert found == {p: (n, n == most[p[1]]) for p, n in counts.items()}


def test_texts_of_one_piece_do_not_mix(tokens):
    aligner = Aligner(A_FILE, B_FILE)
    texts = some_texts()
    whole, single = aligner.align(texts), [aligner.align([t]) for t in texts]
    assert whole.groups == [s.groups[0] for s in single]
    assert whole.links.tolist() == [x for s in single for x in s.links.tolist()]
    assert aligner.align([]).groups == [] and aligner.align(["", ""]).groups == ["", ""]


def test_every_link_is_a_possible_pair():
    aligner = Aligner(A_FILE, B_FILE)
    bound = sum(map(len, aligner.a_bytes)) + 2 * sum(map(len, aligner.b_bytes))
    assert len(aligner.pairs) <= bound
    rnd = random.Random(3)
    for pair in rnd.sample(aligner.pairs.tolist(), 500):
        a, b = aligner.a_bytes[pair >> 32], aligner.b_bytes[pair & 0xFFFFFFFF]
        assert a.endswith(b) or b.endswith(a)


def test_nothing_to_align(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment_report(empty, A_FILE, B_FILE).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], SCHEMA)
    assert [tuple(r) for r in alignment_report(none, A_FILE, B_FILE).select(COLUMNS).orderBy("doc_id").collect()] == [
        (i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_long_text(tokens):
    text = "".join(random.Random(4).choices("abc defgh é", k=300_000))
    a, b = map(spans, tokens(text))
    found = Aligner(A_FILE, B_FILE).align([text])
    assert found.n_groups[0] == len({e for *_, e in a} & {e for *_, e in b})


def test_given_documents(spark, tokens):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op13_token_alignment(spark, sf).select(COLUMNS).collect()]
    small = {r[0] for r in rows if len(r[1] or "") < 2000}
    want, _, _, _ = plain_counts(rows, tokens)
    assert sorted(g for g in got if g[0] in small) == sorted(w for w in want if w[0] in small)


def plain_counts(rows, tokens):
    """As :func:`plain`, with links by common ends instead of all pairs."""
    per, counts = [], Counter()
    for i, text in rows:
        a, b = map(spans, tokens(text))
        ends = {e: j for j, _, e in b}
        links = [(j, ends[e]) for j, _, e in a if e in ends]
        cuts = [e for *_, e in a if e in ends]
        groups, x, y = [], 0, 0
        for cut in cuts:
            x2 = next(k for k in range(x, len(a)) if a[k][2] == cut) + 1
            y2 = next(k for k in range(y, len(b)) if b[k][2] == cut) + 1
            groups.append(f"{','.join(str(s[0]) for s in a[x:x2])}|{','.join(str(s[0]) for s in b[y:y2])}")
            x, y = x2, y2
        per.append((i, len(a), len(b), ";".join(groups), links))
        counts.update(links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [(i, n_a, n_b, g.count("|"), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for i, n_a, n_b, g, links in per], per, counts, most


def test_pieces_whose_bytes_differ_spoil_their_texts_only():
    aligner = Aligner(A_FILE, B_FILE)
    texts = ["plain words here", "a▁b words", "", "words here", "plain a▁b here"]
    for _ in range(2):  # learnt, then looked up
        found = aligner.encode(texts)
        assert [x == (b"", b"") for x in found] == [False, True, True, False, True]
        assert aligner.differ == {"", "a▁b"}  # the empty text is a piece that B gives nothing for
        assert found == [Aligner.encode(aligner, [t])[0] for t in texts]
    assert aligner.known_a.keys() == aligner.known_b.keys() == {"plain", "words", "here", "a▁b", ""}
