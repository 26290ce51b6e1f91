"""Byte-level BPE encoding and decoding with recursive SQL inside each partition.

Every task cuts its texts where a single space stands between two
non-space characters (the tokenizer's pattern always has a boundary there)
and looks the pieces up in a cache. New pieces are split by the pattern, and the
words not met yet go to an in-process DuckDB: token-position rows join the merge
table, each word's leftmost pair of minimum rank is contracted, and the
recursion goes on with the words that changed until none does. Decoding puts each
run of ids together by an ordered aggregation over its position rows. Texts are
never shuffled.

A word of L bytes takes up to L rounds over L rows, so words over
``SQL_WORD_BYTES`` bytes (unbroken runs, rare in any corpus) take a heap over
the same merge rule instead, which costs L log L.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SQL_WORD_BYTES = 256
SQL_ROWS = 400_000
#: the caches are emptied beyond this many bytes; longer pieces and words are not kept from one call to the next
CACHE_BYTES = 192 << 20
CACHED_LENGTH = 200

_ENCODE = """
WITH RECURSIVE state(round, w, pos, tok, next_tok, next_pos) AS (
    SELECT 0, w, pos, tok, next_tok, next_pos FROM tokens
    UNION ALL
    (WITH paired AS MATERIALIZED (
        SELECT s.*, (m.merged::BIGINT << 32) | s.pos AS choice
        FROM state s LEFT JOIN merges m ON m.pair = s.tok::BIGINT * 4294967296 + s.next_tok),
    best AS MATERIALIZED (
        SELECT w, min(choice) AS choice FROM paired WHERE choice IS NOT NULL GROUP BY w),
    taken AS MATERIALIZED (
        SELECT r.w, l.pos AS at, (b.choice >> 32)::INTEGER AS merged, r.pos, r.next_tok, r.next_pos
        FROM best b JOIN paired l ON l.w = b.w AND l.choice = b.choice
        JOIN paired r ON r.w = l.w AND r.pos = l.next_pos)
    SELECT p.round + 1, p.w, p.pos,
           CASE WHEN p.pos = t.at THEN t.merged ELSE p.tok END,
           CASE WHEN p.pos = t.at THEN t.next_tok WHEN p.next_pos = t.at THEN t.merged ELSE p.next_tok END,
           CASE WHEN p.pos = t.at THEN t.next_pos ELSE p.next_pos END
    FROM paired p JOIN taken t ON t.w = p.w WHERE p.pos <> t.pos)
), ended AS (
    SELECT w, max(round) AS round FROM state GROUP BY w
)
SELECT s.w, s.pos, s.tok FROM state s JOIN ended USING (w, round) ORDER BY s.w, s.pos
"""
_DECODE = """
SELECT w, string_agg(v.text, '' ORDER BY i.pos) AS text FROM ids i JOIN vocabulary v USING (tok) GROUP BY w ORDER BY w
"""


class Tokenizer:
    """Merge rule of one rank file; one per Python worker."""

    def __init__(self, rank_file: str, pattern: str, sql_rows: int | None = None, cache_bytes: int | None = None):
        import duckdb
        import regex

        self.sql_rows, self.cache_bytes = sql_rows, cache_bytes  # None: the module's bounds
        self.split = regex.compile(pattern).findall
        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "256MB"})
        for name, columns in (("merges", {"pair": pairs, "merged": pa.array(merged, pa.int32())}),
                              # one character a byte, U+0000 to U+00FF
                              ("vocabulary", {"tok": pa.array(list(self.ranks.values()), pa.int32()),
                                              "text": [t.decode("latin-1") for t in self.ranks]})):
            self.db.register("given", pa.table(columns))
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        #: piece after a space -> ids with that space; other words -> ids; bytes held by both
        self.spaced: dict[str, bytes] = {}
        self.ids: dict[str, bytes] = {}
        self.held = 0
        self.odd_space = regex.compile(r" (?!\S)|[^\S ] |^ ").search
        self.cut = regex.compile(r"(?<=\S) (?=\S)").finditer

    def _long_word(self, word: bytes) -> list[int]:
        """The same merge rule by a heap over neighbouring parts."""
        n = len(word)
        part, after, before = [word[i:i + 1] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            if i >= 0 and after[i] < n:
                joined = part[i] + part[after[i]]
                rank = self.ranks.get(joined)
                if rank is not None:
                    heapq.heappush(heap, (rank, i, joined))

        for i in range(n):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if j >= n or part[i] + part[j] != joined:
                continue
            part[i], part[j], after[i] = joined, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [self.ranks[p] for p in part if p is not None]

    def _ids_sql(self, words: list[bytes]) -> list[bytes]:
        size = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        w = np.repeat(np.arange(len(words), dtype=np.int32), size)
        pos, tok = (np.arange(len(data)) - start[w]).astype(np.int32), self.byte[data]
        follow = np.append(tok[1:], np.int32(-1))
        follow[start[1:] - 1] = -1
        self.db.register("tokens", pa.table({"w": w, "pos": pos, "tok": tok, "next_tok": follow, "next_pos": pos + 1}))
        out = self.db.execute(_ENCODE).fetchnumpy()
        self.db.unregister("tokens")
        cut = (4 * np.searchsorted(out["w"], np.arange(len(words) + 1))).tolist()
        ids = np.asarray(out["tok"]).astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def words_ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit integers."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        out, batch, rows = [b""] * len(words), [], 0

        def flush():
            for i, ids in zip(batch, self._ids_sql([data[i] for i in batch]), strict=True):
                out[i] = ids

        for i, word in enumerate(data):
            if len(word) > SQL_WORD_BYTES:
                out[i] = np.array(self._long_word(word), "<u4").tobytes()
            elif word:
                batch.append(i)
                rows += len(word)
                if rows >= (self.sql_rows or SQL_ROWS):
                    flush()
                    batch, rows = [], 0
        if batch:
            flush()
        return out

    def _pieces(self, text: str) -> list[str]:
        """The text cut before spaces that stand between non-space characters; later pieces lose that space."""
        if self.odd_space(text) is None:
            return text.split(" ")
        cuts = [m.start() for m in self.cut(text)]
        return [text[a:b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(text)], strict=True)]

    def _forget(self) -> None:
        """Keeps the caches within their bound: what is long goes after each call, all of it when they are full."""
        if self.held > (self.cache_bytes or CACHE_BYTES):
            self.spaced.clear()
            self.ids.clear()
            self.held = 0

    def _keep(self, cache: dict[str, bytes], names: list[str], ids: list[bytes], long: list) -> None:
        cache.update(zip(names, ids, strict=True))
        size = 0
        for n, x in zip(names, ids, strict=True):
            if len(n) > CACHED_LENGTH:
                long.append((cache, n))
            else:
                size += len(n) + len(x)
        self.held += size + 250 * len(names)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        self._forget()
        cut = [self._pieces(t) for t in texts]
        heads = [self.split(pieces[0]) for pieces in cut]
        spaced, ids, long = self.spaced, self.ids, []
        fresh = set()
        for pieces in cut:
            fresh.update(pieces[1:])
        fresh = sorted(fresh - spaced.keys())
        # an ASCII word is one match of the pattern together with its space
        split = {p: self.split(" " + p) for p in fresh if not (p.isascii() and p.isalpha())}
        rests = {w for words in split.values() for w in words[1:]}.union(*heads) - ids.keys()
        firsts = {words[0][1:] for words in split.values() if words[0][0] == " "}
        single = sorted(((set(fresh) - split.keys()) | firsts) - spaced.keys())
        rests = sorted(rests.union(*([words[0]] for words in split.values() if words[0][0] != " ")) - ids.keys())
        found = self.words_ids([" " + w for w in single] + rests)
        self._keep(spaced, single, found[:len(single)], long)
        self._keep(ids, rests, found[len(single):], long)
        joined = [(p, b"".join([spaced[words[0][1:]] if words[0][0] == " " else ids[words[0]], *map(ids.__getitem__, words[1:])]))
                  for p, words in split.items() if len(words) > 1 or words[0] != " " + p]
        self._keep(spaced, [p for p, _ in joined], [x for _, x in joined], long)
        out = [b"".join([*map(ids.__getitem__, head), *map(spaced.__getitem__, pieces[1:])])
               for head, pieces in zip(heads, cut, strict=True)]
        for cache, name in long:
            cache.pop(name, None)
        return out

    def decode(self, runs: list[bytes]) -> list[bytes]:
        """The bytes that each run of ids stands for: position rows, ordered aggregation."""
        out, at = [b""] * len(runs), 0
        size = np.cumsum([len(r) // 4 for r in runs])
        while at < len(runs):
            upto = max(at + 1, int(np.searchsorted(size, (self.sql_rows or SQL_ROWS) + (size[at - 1] if at else 0))))
            tok = np.frombuffer(b"".join(runs[at:upto]), "<u4").astype(np.int32)
            w = np.repeat(np.arange(at, upto, dtype=np.int32), [len(r) // 4 for r in runs[at:upto]])
            self.db.register("ids", pa.table({"w": w, "pos": np.arange(len(tok)), "tok": tok}))
            for i, text in self.db.execute(_DECODE).fetchall():
                out[i] = text.encode("latin-1")
            self.db.unregister("ids")
            at = upto
        return out


@lru_cache(maxsize=2)
def _tokenizer(rank_file: str, pattern: str, sql_rows: int | None = None, cache_bytes: int | None = None) -> Tokenizer:
    tokenizer = Tokenizer(rank_file, pattern, sql_rows, cache_bytes)
    # lists of words by the hundred thousand and no cycles: fewer passes of the collector, none over the tables
    gc.freeze()
    gc.set_threshold(200_000, 50, 50)
    return tokenizer


def _pieces(texts: list[str], limit: int = 2 << 20):
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode_texts(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a binary column ``ids``: little-endian unsigned 32-bit token ids of ``text``.

    Each match of ``pattern`` is encoded on its own, without special tokens. Null
    text gives no ids. Rows, their number and the other columns stay as they are.
    """
    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        tok = _tokenizer(rank_file, pattern)
        texts = [t if isinstance(t, str) else "" for t in texts]
        return pd.Series([x for a, b in _pieces(texts) for x in tok.encode(texts[a:b])], dtype=object)

    return df.withColumn(ids, encode(F.col(text)))


def decode_ids(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with a binary column ``decoded``: the bytes that ``ids`` stand for; null ids give none."""
    @F.pandas_udf("binary")
    def decode(runs: pd.Series) -> pd.Series:
        tok = _tokenizer(rank_file, pattern)
        runs = [b"" if x is None else bytes(x) for x in runs]
        return pd.Series([x for a, b in _pieces(runs) for x in tok.decode(runs[a:b])], dtype=object)

    return df.withColumn(decoded, decode(F.col(ids)))


def round_trip(docs: DataFrame, rank_file: str, pattern: str, sql_rows: int | None = None, cache_bytes: int | None = None) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256 of every row's ``text``.

    Encodes the text, then decodes the ids it got, in one Python process per
    task. Null text counts as empty, a null doc_id stays null, repeated rows give
    repeated results; other columns are not read. ``sql_rows`` and ``cache_bytes`` bound
    the rows of a statement and the bytes cached by a worker; the result does not depend on them.
    """
    def run(batches):
        tok = _tokenizer(rank_file, pattern, sql_rows, cache_bytes)
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            for a, b in _pieces(texts):
                ids = tok.encode(texts[a:b])
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[a:b].astype("Int64"), "ids": ids, "n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in tok.decode(ids)]})

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInPandas(run, "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`round_trip`."""
    return round_trip(docs, rank_file, pattern).drop("ids")
