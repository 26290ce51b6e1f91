"""Alignment of two tokenizers' tokens over the same bytes.

Every text is encoded by a byte-level BPE (A) and a sentence-piece BPE (B). Both cut the
same bytes, so tokens are intervals. All tokens of a piece of texts are lexsorted by
start; ``maximum.accumulate`` of their ends tells how far the tokens so far reach, and a group breaks where a
start reaches that maximum, that is where an A and a B token both end. Inside the groups the overlapping
pairs are expanded from the bounds of each A token's overlaps (their number is less than that of both
sides' tokens). Pairs that end together are links.

A link's shorter token is a suffix of the longer, so the id pairs that can ever be linked follow from the
two vocabularies alone: fewer than the bytes of both vocabularies times the ids that share one byte string (two
at most for byte tokens). They are numbered once a worker; a link is kept as its pair's number.
Corpus-wide counts are summed per task, then by pair. The counted pairs, bounded as above (at most about 300,000
rows for the public vocabularies, whatever the corpus), are the only thing that goes to all tasks.
"""

from __future__ import annotations

import gc
import hashlib
import os
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

PIECE = 1 << 20
CACHE_BYTES = 128 << 20


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 ones for themselves, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligned(NamedTuple):
    """What a piece of texts gives: per text the numbers, and per token and link flat arrays."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    links: np.ndarray


class Aligner:
    """Both tokenizers of one pair of files; one per Python worker."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if alphabet.keys() >= set(token) else token.encode()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.vocab_size())]
        self.a_size, self.b_size = (np.array([len(t) for t in v]) for v in (self.a_bytes, self.b_bytes))
        #: "id," and the id that ends a side or a group, for writing groups
        self.shown = [f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"] + [
            f"{i}{c}" for i in range(len(self.b_bytes)) for c in ",;"]
        self.pairs = self._pairs()
        visible = r"[!-~\p{L}]"
        self.space = regex.compile(f"(?<={visible}) (?={visible})").finditer
        self.odd_space = regex.compile(rf"(?<!{visible}) | (?!{visible})").search
        self.whole_only = any(" " in t.lstrip(b" ").decode(errors="replace") for t in self.b_bytes)
        #: piece -> A ids, piece -> B ids; pieces whose bytes differ
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.differ: set[str] = set()
        self.kept = 0

    def _pairs(self) -> np.ndarray:
        """Every (A id << 32 | B id) of which one is a suffix of the other, ascending."""
        a_of, b_of = defaultdict(list), defaultdict(list)
        for i, t in enumerate(self.a_bytes):
            a_of[t].append(i)
        for i, t in enumerate(self.b_bytes):
            b_of[t].append(i)
        found = {a << 32 | b for b, t in enumerate(self.b_bytes) for k in range(len(t)) for a in a_of.get(t[k:], ())}
        found |= {a << 32 | b for a, t in enumerate(self.a_bytes) for k in range(1, len(t)) for b in b_of.get(t[k:], ())}
        return np.array(sorted(found), np.int64)

    def _cut(self, text: str) -> list[str]:
        """The text cut at each space between two visible characters (ASCII or letters); the pieces lose that space."""
        if not self.whole_only and self.odd_space(text) is None:
            return text.split(" ")
        at = [] if self.whole_only else [m.start() for m in self.space(text)]
        return [text[x:y] for x, y in zip([0, *(i + 1 for i in at)], [*at, len(text)], strict=True)]

    def _learn(self, pieces: list[str]) -> None:
        spaced = [" " + p for p in pieces]
        ours = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        theirs = self.b.encode(pieces, num_threads=1)
        data = [p.encode("utf-8", "surrogatepass") for p in spaced]
        size = np.fromiter(map(len, data), np.int64, len(data))
        same = np.ones(len(data), bool)
        for known, ids, token, token_size in ((self.known_a, ours, self.a_bytes, self.a_size),
                                              (self.known_b, theirs, self.b_bytes, self.b_size)):
            flat = list(chain.from_iterable(ids))
            each = np.array(flat, "<u4")
            cut = np.concatenate(([0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))))
            joined = b"".join(map(token.__getitem__, flat))
            ends = np.concatenate(([0], np.cumsum(token_size[each])))[cut]
            same &= np.diff(ends) == size
            if joined != b"".join(data):
                same &= [joined[x:y] == d for x, y, d in zip(ends[:-1].tolist(), ends[1:].tolist(), data, strict=True)]
            held, at = each.tobytes(), (4 * cut).tolist()
            known.update(zip(pieces, [held[x:y] for x, y in zip(at, at[1:], strict=False)], strict=True))
            self.kept += len(held)
        self.differ.update(pieces[i] for i in np.flatnonzero(~same).tolist())
        self.kept += 300 * len(pieces) + 4 * sum(map(len, pieces))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """A ids of space + text and B ids of text as 32-bit integers; none where a side's joined bytes are not those of space + text.

        Both tokenizers always have a token border before a single space between visible characters: A's
        pattern starts a new word there, and no piece of B has a space after another character (else texts are
        not cut). So the pieces between such spaces are encoded once each and looked up from then on.
        """
        if self.kept > CACHE_BYTES:
            self.known_a.clear()
            self.known_b.clear()
            self.differ.clear()
            self.kept = 0
        cut = [self._cut(t) for t in texts]
        self._learn(sorted(set().union(*cut) - self.known_a.keys()))
        a, b = self.known_a.__getitem__, self.known_b.__getitem__
        return [(b"".join(map(a, pieces)), b"".join(map(b, pieces))) if text and self.differ.isdisjoint(pieces) else (b"", b"")
                for text, pieces in zip(texts, cut, strict=True)]

    def align(self, texts: list[str]) -> Aligned:
        ids = self.encode(texts)
        n_a, n_b = (np.array([len(x[k]) // 4 for x in ids], np.int64) for k in (0, 1))
        a, b = (np.frombuffer(b"".join([x[k] for x in ids]), "<u4").astype(np.int64) for k in (0, 1))
        zeros = np.zeros(len(texts), np.int64)
        if not len(a):
            return Aligned(n_a, n_b, zeros, zeros, zeros, [""] * len(texts), np.empty(0, "<u4"))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]

        start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
        order = np.lexsort((end, start))
        reach = np.maximum.accumulate(end[order])
        breaks = np.ones(len(order), bool)
        breaks[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(breaks) - 1
        a_group, b_group = group[:len(a)], group[len(a):]

        low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        some = high - low
        left = np.repeat(np.arange(len(a)), some)
        right = np.arange(len(left)) - np.repeat(np.cumsum(some) - some - low, some)
        together = a_end[left] == b_end[right]
        linked = left[together]
        pair = np.searchsorted(self.pairs, a[linked] << 32 | b[right[together]]).astype("<u4")

        text_of = np.repeat(np.arange(len(texts)), n_a)
        n_groups = np.bincount(text_of[np.flatnonzero(np.diff(a_group, prepend=-1))], minlength=len(texts))
        n_overlaps = np.bincount(text_of, some, len(texts)).astype(np.int64)
        n_links = np.bincount(text_of[linked], minlength=len(texts))
        return Aligned(n_a, n_b, n_groups, n_overlaps, n_links, self._written(a, b, a_group, b_group, n_a + n_b), pair)

    def _written(self, a, b, a_group, b_group, size) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text: a group's A ids, then its B ids."""
        a_last, b_last = np.diff(a_group, append=-1) != 0, np.diff(b_group, append=-1) != 0
        per_a, per_b = np.bincount(a_group), np.bincount(b_group)
        a_before, b_before = np.cumsum(per_a), np.cumsum(per_b) - per_b
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + b_before[a_group]] = 2 * a + a_last
        line[np.arange(len(b)) + a_before[b_group]] = 2 * len(self.a_bytes) + 2 * b + b_last
        written = list(map(self.shown.__getitem__, line.tolist()))
        ends = list(accumulate(size.tolist()))
        return ["".join(written[x:y])[:-1] for x, y in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=2)
def _aligner(a_file: str, b_file: str) -> Aligner:
    aligner = Aligner(a_file, b_file)
    # lists of ids by the hundred thousand and no cycles: fewer passes of the collector, none over the tables
    gc.freeze()
    gc.set_threshold(200_000, 50, 50)
    return aligner


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PIECE:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def align_tokens(docs: DataFrame, a_file: str, b_file: str, key: str = "doc_id", text: str = "text",
                 groups: bool = True) -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_overlaps, n_links, groups_sha256, links and, if asked for, groups of each row's text.

    ``groups`` writes the ids of each group, ``groups_sha256`` is its digest ('' without tokens); ``links`` holds the pair number of each
    link as little-endian 32-bit integers (:func:`pair_ids` names the pairs). Null and empty texts, and texts
    that one of the tokenizers does not give back byte by byte, have no tokens: zeros and empty strings. Null keys
    and repeated rows are kept as they are; other columns are not read; an empty table gives no rows.
    """
    key_type = docs.schema[key].dataType
    numbers = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links"]
    ddl = (f"`{key}` {key_type.simpleString()}, {', '.join(f'{n} long' for n in numbers)}, groups_sha256 string, links binary"
           + (", groups string" if groups else ""))
    schema = pa.schema([(key, to_arrow_type(key_type)), *((n, pa.int64()) for n in numbers), ("groups_sha256", pa.string()),
                        ("links", pa.binary()), *([("groups", pa.string())] if groups else [])])

    def run(batches):
        aligner = _aligner(a_file, b_file)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _pieces(texts):
                found = aligner.align(texts[lo:hi])
                cut = np.cumsum(found.n_links)
                links = [x.tobytes() for x in np.split(found.links, cut[:-1])]
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
                columns = [batch.column(0).slice(lo, hi - lo).cast(schema[0].type), *map(pa.array, found[:5]), pa.array(digests),
                           pa.array(links, pa.binary()), *([pa.array(found.groups)] if groups else [])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col(key), F.col(text).cast("string").alias("aligned text")).mapInArrow(run, ddl)


def pair_counts(aligned: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(pair, a_id, b_id, n, best): how many links of all texts hold each id pair; ``best`` where no pair of the B id has more."""
    def count(batches):
        pairs = _aligner(a_file, b_file).pairs
        total = np.zeros(len(pairs), np.int64)
        for batch in batches:
            data = b"".join(x for x in batch.column(0).to_pylist() if x)
            total += np.bincount(np.frombuffer(data, "<u4"), minlength=len(pairs))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(pairs[seen] >> 32), pa.array(pairs[seen] & 0xFFFFFFFF),
                                          pa.array(total[seen])], names=["pair", "a_id", "b_id", "n"])

    counts = stored(aligned.select("links").mapInArrow(count, "pair long, a_id long, b_id long, n long")
                    .groupBy("pair", "a_id", "b_id").agg(F.sum("n").alias("n")), "pair-counts")
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return counts.join(most, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """``aligned`` without links, with n_best (links whose pair is its B id's commonest) and count_sum (their pairs' counts summed).

    ``counts`` is bounded by the two vocabularies and goes to every task.
    """
    found = counts.select("pair", "n", "best").toArrow()
    size = max(found.column("pair").to_pylist(), default=-1) + 1
    number, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = found.column("pair").to_numpy()
    number[at], best[at] = found.column("n").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
    shared = aligned.sparkSession.sparkContext.broadcast((number, best))
    kept = [c for c in aligned.columns if c != "links"]
    place = aligned.columns.index("links")

    def run(batches):
        number, best = shared.value
        for batch in batches:
            links = [np.frombuffer(x, "<u4") for x in batch.column(place).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != place]
            sums = [(int(best[x].sum()), int(number[x].sum())) for x in links]
            n_best, count_sum = zip(*sums, strict=True) if sums else ((), ())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                                             names=[*kept, "n_best", "count_sum"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name != "links")
    return aligned.mapInArrow(run, f"{fields}, n_best long, count_sum long")


def alignment_report(docs: DataFrame, a_file: str, b_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum, groups_sha256 of each row; see :func:`align_tokens`.

    The aligned rows are written once; counting and scoring read them, so that no text is encoded twice.
    """
    aligned = stored(align_tokens(docs, a_file, b_file, key, text, groups=False), "aligned")
    return score_links(aligned, pair_counts(aligned, a_file, b_file), key)
