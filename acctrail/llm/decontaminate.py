"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are lower-cased words of letters, marks and digits; characters of scripts
written without spaces are words of their own. A document matches an item
of m words when some run of its words has word edit distance at most
``floor(edits * m)`` to the item.

* With at most a fifth of the words edited, items of at least ``MIN_WORDS``
  words keep a run of three words unchanged (pigeonhole), so only windows
  aligned with a three-word run of some item are looked at. This loses nothing.
* Key agreement falls as the number of edits grows, so an item of more than
  ``PIECE`` words is cut into equal pieces of at most ``PIECE`` words. The
  edits of a match spread over the pieces, so at least one piece is within
  the same edit rate, whatever the length of the item.
* Each such piece-sized window, and each piece, is embedded by ``tables``
  independent CGK random walks, which turn edit distance into Hamming
  distance; a table's key is the words at ``samples`` sampled walk positions. Windows and
  pieces that share a key in any table are candidates.
* A candidate is verified by the exact edit distance of the whole item to the best
  run around the place that the window gives it (bit-parallel).
* Items under ``MIN_WORDS`` words allow one edit at most. All forms that a run within it
  can take are looked up by their hashes, which loses nothing.

Items are handled in blocks of bounded size, each sent to all tasks. The result of
a block is written before the next block is read, so the driver and the plan hold one block, however
large the benchmark. Documents are scanned where they lie, without a shuffle.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, stored, text_of
from .textarrays import Words, chunks, mix

RUN, MIN_WORDS, PIECE, BLOCK_WORDS = 3, 6, 40, 2_000_000
_KEEP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_PAD = np.uint64(0x1F83D9ABFB41BD6B)
_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")
#: Thai and Lao, Myanmar, Khmer, kana and Bopomofo, Han, halfwidth kana
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]


class _Units(dict):
    """Code point to itself, to itself as a word (scripts without spaces), or to a space."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        word = unicodedata.category(c)[0] in "LMN"
        self[code] = out = " " if not word else f" {c} " if any(a <= code <= b for a, b in _UNSPACED) else c
        return out


_UNITS = _Units()


def _normal(text: str) -> bytes:
    text = text.lower()
    if not text.isascii():
        text = _BEYOND_ASCII.sub(lambda m: m[0].translate(_UNITS), text)
    return text.encode("utf-8").translate(_KEEP)


def _keys(words: np.ndarray, start: np.ndarray, end: np.ndarray, size: np.ndarray, tables: int, samples: int, seed: int) -> np.ndarray:
    """Keys (window x table) of windows of ``size`` words at ``start``; past ``end`` they are padded.

    All windows and tables walk together, one step of their CGK walks at a time.
    """
    share = np.sort(np.random.default_rng(seed).random((tables, samples)), axis=1)
    # a walk ends near 2 * size steps, so positions beyond would be padding
    picks = (share[None] * (2 * size - size // 4)[:, None, None]).astype(np.int64)
    at = np.repeat(start[:, None], tables, axis=1)
    limit = np.minimum(start + size, end)[:, None]
    table = np.arange(tables, dtype=np.uint64) + np.uint64(seed << 8)
    key = mix(size.astype(np.uint64))[:, None] + table[None]
    for j in range(int(picks.max()) + 1 if picks.size else 0):
        w = np.where(at < limit, words[np.minimum(at, len(words) - 1)], _PAD)
        for s in range(samples):
            hit = picks[:, :, s] == j
            if hit.any():
                key[hit] = mix(key[hit] * np.uint64(0x9E3779B97F4A7C15) + w[hit])
        salt = mix(table * np.uint64(0xD1B54A32D192ED03) + np.uint64(j))
        at += (mix(w ^ salt) & np.uint64(1)).astype(np.int64)
    return key


def best_run(pattern: list, text: list, anchored: bool = False) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to a run of ``text``, end of the first such run).

    ``anchored`` runs begin with the text. Bit-parallel over the pattern (one integer of len(pattern) bits per step).
    """
    m = len(pattern)
    places: dict = {}
    for i, w in enumerate(pattern):
        places[w] = places.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        eq = places.get(w, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = minus | ~(d | plus) & full, plus & d
        score += (up & top != 0) - (down & top != 0)
        up, down = (up << 1 | anchored) & full, down << 1 & full
        plus, minus = (down | ~(d | up)) & full, up & d
        if score < best:
            best, end = score, j + 1
    return best, end


def _forms(m: int, edits: int):
    """(words of an item of ``m`` words, their places in a run, distance) of the runs within ``edits`` (0 or 1).

    Runs with an edited word at an end are left out: without it they are one word shorter, at the same distance.
    """
    every = tuple(range(m))
    yield every, every, 0
    for i in every if edits else ():
        less = every[:i] + every[i + 1:]
        yield less, every[:-1], 1
        if 0 < i < m - 1:
            yield less, less, 1
        if i:
            yield every, every[:i] + tuple(x + 1 for x in every[i:]), 1


def _spread(words: np.ndarray, start: np.ndarray, places: tuple) -> np.ndarray:
    """Hash of the words at ``places`` after each start."""
    key = np.full(len(start), len(places), np.uint64)
    for j in places:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + words[start + j])
    return key


def _equal(table: np.ndarray, keys: np.ndarray):
    """(index of the key, index in the sorted table) of all equal pairs."""
    lo = np.searchsorted(table, keys, "left")
    n = np.searchsorted(table, keys, "right") - lo
    hit = np.repeat(np.arange(len(keys)), n)
    return hit, lo[hit] + np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)


class ShortItems:
    """Items of fewer than MIN_WORDS words: their forms by the places of the words."""

    def __init__(self, w: Words, edits: float):
        parts: dict = {}
        for m in range(1, MIN_WORDS):
            use = np.flatnonzero(w.count == m)
            for words, places, d in _forms(m, int(edits * m)) if len(use) else ():
                parts.setdefault(places, []).append((_spread(w.hash, w.first[use], words), use, np.full(len(use), d)))
        self.forms = []
        for places, part in parts.items():
            key, item, d = map(np.concatenate, zip(*part, strict=True))
            order = np.argsort(key, kind="stable")
            self.forms.append((places, key[order], item[order], d[order]))

    def matches(self, w: Words):
        """(text, item, distance, first word, words): the least distance, then the first end, then the shortest run."""
        found = []
        for places, keys, item, d in self.forms:
            n = places[-1] + 1
            start = np.flatnonzero(w.doc[:len(w.doc) - n + 1] == w.doc[n - 1:]) if len(w.doc) >= n else np.zeros(0, np.int64)
            hit, entry = _equal(keys, _spread(w.hash, start, places))
            at = start[hit]
            found.append(np.stack([w.doc[at], item[entry], d[entry], at + n, np.full(len(at), n)]))
        if not found:
            return []
        rows = np.concatenate(found, axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(0)
        return [(doc, k, d, end - n - int(w.first[doc]), n) for doc, k, d, end, n in rows[:, new].T.tolist()]


class Index:
    """Run hashes and LSH keys of a block of items; its size is bounded by BLOCK_WORDS."""

    def __init__(self, items: list[tuple[int, str]], edits: float, tables: int, samples: int, seed: int):
        self.tables, self.samples, self.seed = tables, samples, seed
        w = Words([_normal(t) for _, t in items])
        use = np.flatnonzero(w.count >= MIN_WORDS)
        self.short, self.short_ids = ShortItems(w, edits), [k for k, _ in items]
        self.ids = [items[i][0] for i in use]
        self.words = [w.hash[w.first[i]:w.first[i] + w.count[i]].tolist() for i in use]
        self.edits = [int(edits * len(x)) for x in self.words]
        n = -(-w.count[use] // PIECE)
        self.item = np.repeat(np.arange(len(use)), n)
        number, n, m = np.arange(len(self.item)) - np.repeat(np.cumsum(n) - n, n), n[self.item], w.count[use][self.item]
        self.offset = number * m // n
        size = (number + 1) * m // n - self.offset
        first = w.first[use][self.item] + self.offset
        piece = np.full(len(w.hash), -1)
        piece[np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)] = np.repeat(np.arange(len(size)), size)
        start, gram = w.grams(RUN)
        keep = (piece[start] >= 0) & (piece[start] == piece[start + RUN - 1])
        start, gram = start[keep], gram[keep]
        own = piece[start]
        place = pd.DataFrame({"gram": gram, "at": start - first[own], "size": size[own]}).drop_duplicates().sort_values("gram", kind="stable")
        self.gram, self.at, self.size = (place[c].to_numpy() for c in ("gram", "at", "size"))
        keys = _keys(w.hash, first, first + size, size, tables, samples, seed)
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.owner = keys.ravel()[order], np.repeat(np.arange(len(size)), tables)[order]

    def windows(self, w: Words):
        """(first word, size) of piece-sized windows aligned with a run of some piece."""
        start, gram = w.grams(RUN)
        hit, entry = _equal(self.gram, gram)
        doc = w.doc[start[hit]]
        # an alignment that begins before the document is one with its start
        begin = np.maximum(start[hit] - self.at[entry], w.first[doc])
        pairs = np.unique(np.stack([begin, self.size[entry]]), axis=1) if len(hit) else np.zeros((2, 0), np.int64)
        return pairs[0], pairs[1]

    def matches(self, w: Words):
        """(text, item, distance, first word, words) of verified candidates, the best of each text and item."""
        s, sizes = self.windows(w)
        end = w.first[w.doc[s]] + w.count[w.doc[s]]
        keys = _keys(w.hash, s, end, sizes, self.tables, self.samples, self.seed).ravel()
        lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        seen = {(int(x) // self.tables, int(p)) for x in np.flatnonzero(hi > lo) for p in self.owner[lo[x]:hi[x]]}
        regions = set()
        for i, p in seen:
            doc, k, at = int(w.doc[s[i]]), int(self.item[p]), int(s[i]) - int(self.offset[p])
            slack = self.edits[k]
            regions.add((doc, k, max(int(w.first[doc]), at - slack), min(int(end[i]), at + len(self.words[k]) + slack)))
        # overlapping regions of one item are verified as one
        joined: list = []
        for doc, k, a, b in sorted(regions):
            if joined and joined[-1][:2] == [doc, k] and a <= joined[-1][3]:
                joined[-1][3] = max(b, joined[-1][3])
            else:
                joined.append([doc, k, a, b])
        best: dict = {}
        for doc, k, a, b in joined:
            d, stop = best_run(self.words[k], w.hash[a:b].tolist())
            if d <= self.edits[k] and d < best.get((doc, k), (len(self.words[k]),))[0]:
                best[doc, k] = d, a, a + stop
        out = [(doc, self.short_ids[k], *rest) for doc, k, *rest in self.short.matches(w)]
        for (doc, k), (d, a, stop) in best.items():
            # the shortest run of that distance and end
            _, length = best_run(self.words[k][::-1], w.hash[a:stop].tolist()[::-1], anchored=True)
            out.append((doc, self.ids[k], d, stop - length - int(w.first[doc]), length))
        return out


def _distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _blocks(items: DataFrame):
    """Items in blocks of at most BLOCK_WORDS words (a longer item alone), read one by one."""
    block, size = [], 0
    for r in items.toLocalIterator():
        n = len(_normal(r["text"]).split())
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of(benchmark).alias("text"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = 0.2, tables: int = 24, samples: int = 2,
                      seed: int = 11) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, with all columns. A job for every block but the last.

    Null and empty texts and items match nothing; repeated rows and null doc_ids are judged row by
    row. An empty benchmark leaves ``docs`` as it is.
    """
    later = False
    for block in _blocks(_items(benchmark)):
        if later:
            docs = stored(docs, "decontaminated")
        docs = docs.where(~_matching(Index(block, edits, tables, samples, seed))(text_of(docs)))
        later = True
    return docs


def _matching(index: Index):
    @F.pandas_udf("boolean")
    def hit(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        for at, part in chunks([_normal(t) for t in texts]):
            out[[at + doc for doc, *_ in index.matches(Words(part))]] = True
        return pd.Series(out)

    return hit


def find_passages(docs: DataFrame, benchmark: DataFrame, edits: float = 0.2, tables: int = 24, samples: int = 2, seed: int = 11) -> DataFrame:
    """doc_id, item_id, distance, first_word, n_words: best verified match of each row of ``docs`` and item.

    distance counts word edits; first_word and n_words place the matching run
    among the document's normalised words. Items without words (null and empty ones too) match
    nothing, nor do null and empty texts. Null ids stay null, repeated rows of
    ``docs`` give repeated results, repeated items one row each. Other columns are not read.
    ``edits`` is at most 0.2: beyond that the three-word alignment could miss matches.
    Runs a job for every block of items but the last.
    """
    if not 0 <= edits <= 0.2:
        raise ValueError("edits must be between 0 and 0.2")
    schema = "doc_id long, item_id long, distance int, first_word long, n_words int"
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def scan(index: Index):
        def run(batches):
            for pdf in batches:
                ids = pdf["doc_id"].astype("Int64")
                rows = [(ids.iat[at + doc], *rest)
                        for at, part in chunks([_normal(t) for t in pdf["text"]])
                        for doc, *rest in index.matches(Words(part))]
                if rows:
                    out = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "first_word", "n_words"])
                    yield out.astype({"doc_id": "Int64", "item_id": "Int64"})
        return run

    spark, path = docs.sparkSession, None
    found = None
    for block in _blocks(_items(benchmark)):
        if found is not None:
            path = path or f"{shared_dir(spark)}/llm/passages-{os.urandom(8).hex()}"
            found.write.mode("append").option("compression", "zstd").parquet(path)
            found = None  # and its index, before the next is built
        found = base.mapInPandas(scan(Index(block, edits, tables, samples, seed)), schema)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.unionByName(spark.read.schema(schema).parquet(path)) if path else found
