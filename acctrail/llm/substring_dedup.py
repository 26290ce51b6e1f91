"""Removal of word spans that already occurred earlier in the corpus.

The graph is the de Bruijn graph of the corpus: an edge is a run of ``k``
words. Minimiser runs stand in for its nonbranching paths, before any shuffle: consecutive edges of a
document that share a minimiser (the smallest hash among the ``ANCHOR``-word
runs inside an edge) form one path row. Equal edges always have equal
minimisers, so a path whose minimiser occurs once in the corpus holds no
repeated edge and is dropped after one range shuffle. Among the others,

* equal paths (same minimiser, same hash of all their words) are one
  compacted repeat: all but the earliest are removed as a whole;
* the earliest of each are joined back to the text, opened into their edges,
  and each edge is held against the earliest edge with the same two
  independent 64-bit hashes by source coordinates (doc_id, start).

Equality rests on these hashes; the words themselves are not compared.

Both shuffles are by range over (hash, document, position), so the copies of a
passage that a third of all documents share spread over many tasks, and
each task streams through its rows in order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .textarrays import Words, as_bytes, chunks, signed, span_hash

ANCHOR = 6
_LAST_ID = (1 << 63) - 1
_PATH_BASE, _CHECK_BASE = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93 | 1


def _paths(words: Words, k: int):
    """Maximal runs of edges with one minimiser: first edge, last edge, minimiser."""
    n = len(words.hash) - k + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, np.zeros(0, np.uint64)
    edge = np.flatnonzero(words.doc[:n] == words.doc[k - 1:])
    if not len(edge):
        return none, none, np.zeros(0, np.uint64)
    # every ANCHOR-run, those across texts included: no edge contains such a run
    at = np.arange(len(words.hash) - ANCHOR + 1)
    gram = span_hash(words.sums(), 0xC2B2AE3D27D4EB4F, at, at + ANCHOR)
    low, where = gram[edge], edge.copy()
    for j in range(1, k - ANCHOR + 1):
        g = gram[edge + j]
        less = g < low
        np.copyto(low, g, where=less)
        np.copyto(where, edge + j, where=less)
    new = np.ones(len(edge), bool)
    new[1:] = (where[1:] != where[:-1]) | (edge[1:] != edge[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(edge)) - 1
    return edge[first], edge[last], low[first]


def _place(text: bytes, variants: bool) -> int:
    """High bits of positions; they tell texts under one repeated doc_id apart."""
    return (zlib.crc32(text) & 0x3FFFFFFF) << 32 if variants else 0


def _emit_paths(k: int, variants: bool):
    def run(batches):
        for pdf in batches:
            texts, ids = as_bytes(pdf["text"]), pdf["doc"].to_numpy(np.int64)
            for at, part in chunks(texts):
                w = Words(part)
                a, b, low = _paths(w, k)
                if not len(a):
                    continue
                doc = w.doc[a]
                base = np.array([_place(t, variants) for t in part], np.int64)
                yield pd.DataFrame({
                    "low": signed(low),
                    "path": signed(span_hash(w.sums(_PATH_BASE), _PATH_BASE, a, b + k)),
                    "doc": ids[at + doc], "pos": base[doc] + a - w.first[doc],
                    "edges": (b - a + 1).astype(np.int32)})
    return run


def _run_starts(keys: list[np.ndarray], carry: tuple | None):
    """Per row, whether it opens a run of equal keys; the first row against ``carry``."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    new[0] = carry is None or any(key[0] != c for key, c in zip(keys, carry, strict=True))
    return new


def _mark_paths(batches):
    """Rows in (low, path, doc, pos) order: drop lone minimisers, tell copies apart.

    The first and last row of a partition count as repeated and as
    earliest: the edge step decides them.
    """
    held, carry, origin = None, None, None
    first_batch = True
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        low, path = pdf["low"].to_numpy(), pdf["path"].to_numpy()
        doc, pos = pdf["doc"].to_numpy(), pdf["pos"].to_numpy()
        new = _run_starts([low, path], carry[:2] if carry else None)
        lead = np.maximum.accumulate(np.where(new, np.arange(len(pdf)), -1))
        known = lead >= 0
        odoc = np.where(known, doc[lead], origin[0] if origin else 0)
        opos = np.where(known, pos[lead], origin[1] if origin else 0)
        pdf["copy"] = (doc != odoc) | (pos != opos)
        before = np.ones(len(pdf), bool)
        before[1:] = low[1:] == low[:-1]
        before[0] = first_batch or (carry is not None and carry[0] == low[0])
        after = np.ones(len(pdf), bool)
        after[:-1] = low[1:] == low[:-1]
        keep = before | after
        # the last row waits for its successor
        held = pdf.iloc[[-1]][["low", "path", "doc", "pos", "edges"]]
        tail = pdf.iloc[[-1]][["doc", "pos", "edges", "copy"]]
        if len(pdf) > 1:
            first_batch = False
            carry, origin = (low[-2], path[-2]), (odoc[-2], opos[-2])
        keep[-1] = False
        out = pdf.loc[keep, ["doc", "pos", "edges", "copy"]]
        if len(out):
            yield out
    if held is not None:
        yield tail


def _emit_edges(k: int, variants: bool):
    def run(batches):
        for pdf in batches:
            texts, ids = as_bytes(pdf["text"]), pdf["doc"].to_numpy(np.int64)
            for at, part in chunks(texts):
                w = Words(part)
                starts, owner, places = [], [], []
                for i, text in enumerate(part):
                    base = _place(text, variants)
                    spans = [(s["pos"] - base, s["edges"]) for s in pdf["spans"].iloc[at + i]]
                    for s, e in spans:
                        if 0 <= s and s + e + k - 1 <= w.count[i]:
                            starts.append(np.arange(s, s + e))
                            owner.append(np.full(e, i))
                            places.append(base)
                if not starts:
                    continue
                size = [len(s) for s in starts]
                local, own = np.concatenate(starts), np.concatenate(owner)
                s = local + w.first[own]
                yield pd.DataFrame({
                    "h1": signed(span_hash(w.sums(_PATH_BASE), _PATH_BASE, s, s + k)),
                    "h2": signed(span_hash(w.sums(_CHECK_BASE), _CHECK_BASE, s, s + k)),
                    "doc": ids[at + own], "pos": np.repeat(np.array(places, np.int64), size) + local})
    return run


def _mark_edges(batches):
    """Rows in (h1, h2, doc, pos) order. kind 0: repeated edge. A run at the
    start of the partition may have begun earlier: its first coordinates come
    out as kind 1, and the partition's last run as kind 2, for _settle."""
    from pyspark import TaskContext
    pid = TaskContext.get().partitionId()
    carry, origin, opening, seen = None, None, None, False
    for pdf in batches:
        if not len(pdf):
            continue
        h1, h2 = pdf["h1"].to_numpy(), pdf["h2"].to_numpy()
        doc, pos = pdf["doc"].to_numpy(), pdf["pos"].to_numpy()
        new = _run_starts([h1, h2], carry)
        lead = np.maximum.accumulate(np.where(new, np.arange(len(pdf)), -1))
        known = lead >= 0
        odoc = np.where(known, doc[lead], origin[0] if origin else 0)
        opos = np.where(known, pos[lead], origin[1] if origin else 0)
        if not seen:
            opening, seen = (h1[0], h2[0]), True
        repeated = (doc != odoc) | (pos != opos)
        pdf["kind"], pdf["pid"] = np.where(repeated, 0, 1).astype(np.int32), np.int32(pid)
        out = pdf[repeated | ((h1 == opening[0]) & (h2 == opening[1]))]
        if len(out):
            yield out
        carry, origin = (h1[-1], h2[-1]), (odoc[-1], opos[-1])
    if carry is not None:
        yield pd.DataFrame({"h1": [carry[0]], "h2": [carry[1]], "doc": [origin[0]], "pos": [origin[1]],
                            "kind": np.array([2], np.int32), "pid": np.array([pid], np.int32)})


def _settle(marked: DataFrame) -> DataFrame:
    """Repeated edges: kind 0, and openings whose run began in an earlier partition."""
    key = ["h1", "h2"]
    tails = marked.where("kind = 2").select(*key, F.col("pid").alias("tail_pid"), F.col("doc").alias("tail_doc"),
                                            F.col("pos").alias("tail_pos"))
    late = (marked.where("kind = 1").join(tails, key)
            .where("tail_pid < pid and (tail_doc < doc or tail_doc = doc and tail_pos < pos)")
            .select("doc", "pos").distinct())
    return marked.where("kind = 0").select("doc", "pos").unionByName(late)


def _cut(k: int, variants: bool):
    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, text, spans in zip(pdf["doc_id"], pdf["text"], pdf["spans"], strict=True):
                data = as_bytes([text])[0]
                words, base = data.split(), _place(data, variants)
                gone = np.zeros(len(words) + 1, np.int64)
                for s in () if spans is None else spans:
                    at = s["pos"] - base
                    if 0 <= at and at + s["size"] <= len(words):
                        gone[at] += 1
                        gone[at + s["size"]] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_text"]).astype({"doc_id": "Int64"})
    return run


def _placed(spans: DataFrame) -> DataFrame:
    """With ``place``, the checksum of the text that ``_place`` put into the high bits of positions."""
    return spans.withColumn("place", F.shiftright("pos", 32))


def dedup_substrings(docs: DataFrame, k: int = 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_text.

    Every word covered by a window of ``k`` words whose sequence also starts
    earlier (smaller doc_id, or same doc_id and earlier start) is removed; the kept
    words are joined by one space. Windows are judged on the input.

    Null text and texts without words give zero counts and empty text. A null
    doc_id sorts after all others and stays null. Rows equal in doc_id and
    text hold the same place, so neither removes words of the other; different
    texts under one doc_id are ordered by a checksum of the text. Other
    columns of ``docs`` are not read. Runs jobs (see ``common.stored``).
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("doc"))
    variants = not base.groupBy("doc").count().where("count > 1").isEmpty()
    # spans meet per text, not per id: rows without an id, or of one id, may be many
    of_text = ["doc", "place"] if variants else ["doc"]
    if variants:
        base = base.withColumn("place", F.crc32("text").bitwiseAND(0x3FFFFFFF))
    order = ["low", "path", "doc", "pos"]
    paths = base.select("doc", "text").mapInPandas(_emit_paths(k, variants),
                                                   "low long, path long, doc long, pos long, edges int")
    marked = stored(paths.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInPandas(_mark_paths, "doc long, pos long, edges int, copy boolean"), "paths")
    firsts = _placed(marked.where("not copy")).groupBy(*of_text).agg(F.collect_set(F.struct("pos", "edges")).alias("spans"))
    order = ["h1", "h2", "doc", "pos"]
    edges = (base.select(*of_text, "text").join(firsts, of_text)
             .mapInPandas(_emit_edges(k, variants), "h1 long, h2 long, doc long, pos long"))
    repeated = _settle(stored(edges.repartitionByRange(*order).sortWithinPartitions(*order)
                              .mapInPandas(_mark_edges, "h1 long, h2 long, doc long, pos long, kind int, pid int"),
                              "edges"))
    spans = (_placed(marked.where("copy").select("doc", "pos", (F.col("edges") + (k - 1)).alias("size"))
                     .unionByName(repeated.select("doc", "pos", F.lit(k).alias("size"))))
             .groupBy(*of_text).agg(F.collect_set(F.struct("pos", "size")).alias("spans")))
    return (base.join(spans, of_text, "left").select("doc_id", "text", "spans")
            .mapInPandas(_cut(k, variants), "doc_id long, n_words long, n_removed long, kept_text string"))
