"""Document fingerprints by locally consistent parsing.

A text is parsed in rounds, from its code points to one name for the whole. Each round
names every run of one repeated name by name and length, so that neighbours differ; tosses
deterministic coins (a name's label is the place and value of the lowest bit in which it differs from its
left neighbour; four tosses leave six labels, and neighbours still differ); starts a phrase at each
local maximum of the labels; and names the phrase by a hash of its names. Where a phrase
starts depends on a few names around it only, so equal substrings are parsed alike but for a few
phrases at their ends, at whatever offset they stand.

A fingerprint is the name of the whole text and the ``size`` smallest of the distinct phrase names from
round ``level`` on (round 3: phrases of about 15 characters). From two fingerprints the likeness of the two name
sets (intersection by union) is estimated, exactly where the union has at most ``size`` names.

Parsing works on numpy arrays of many texts at once inside Spark tasks. Memory follows the
longest single text (about 100 bytes a character); texts are otherwise taken in pieces of
``PIECE`` characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

PIECE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BITS = 40
_DIGITS = _BITS // 4


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit words over all others; changes ``x``."""
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def _toss_table() -> np.ndarray:
    left, own = np.mgrid[:128, :128].astype(np.int64)
    differ = left ^ own
    differ[differ == 0] = 1
    place = np.bitwise_count((differ & -differ) - 1).astype(np.int64)
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _tossed(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5 by four coin tosses; neighbours of one text differ. ``first``: places where a text begins."""
    differ = names.copy()
    differ[1:] ^= names[:-1]
    differ[first] = 1
    differ[differ == 0] = 1
    differ &= ~differ + np.uint64(1)
    place = np.bitwise_count(differ - np.uint64(1))
    label = (place << 1) | ((names & differ) != 0)
    for _ in range(3):
        pair = label.astype(np.int16)
        pair[1:] += label[:-1].astype(np.int16) << 7
        pair[first] = label[first].astype(np.int16) + ((label[first] ^ 1).astype(np.int16) << 7)
        label = _TOSS[pair]
    return label


def parse_round(names: np.ndarray, first: np.ndarray, round_: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrase names of one round, and where each text's first phrase stands.

    ``names`` holds the names of all texts one after the other, ``first`` the place of each text's first one.
    """
    begins = np.zeros(len(names), bool)
    begins[first] = True
    fresh = begins.copy()
    fresh[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(fresh)
    if len(at) < len(names):
        length = np.diff(at, append=len(names))
        names, begins = names[at], begins[at]
        many = np.flatnonzero(length > 1)
        names[many] = _mix(names[many] * _MIX2 + length[many].astype(np.uint64) * _ODD)
        first = np.flatnonzero(begins)
    label = _tossed(names, first)
    cut = np.zeros(len(names), bool)
    cut[2:] = label[2:] > label[1:-1]
    cut[:-1] &= (label[:-1] > label[1:]) | begins[1:]
    cut[first[first + 1 < len(names)] + 1] = False
    cut[first] = True
    at = np.flatnonzero(cut)
    size = np.diff(at, append=len(names))
    place = (np.arange(len(names)) - np.repeat(at, size)).astype(np.uint64)
    place *= _ODD
    place += names
    phrases = np.add.reduceat(_mix(place), at)
    phrases += np.uint64(round_)
    return _mix(phrases), np.flatnonzero(begins[at])


def phrase_names(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(round, text number of each phrase, phrase name) of every round.

    A text leaves after the round that made it one phrase; empty texts have no phrase.
    """
    size = np.array([len(t) for t in texts], np.int64)
    text = np.flatnonzero(size)
    if not len(text):
        return
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    first = (np.cumsum(size) - size)[text]
    round_ = 0
    while len(text):
        round_ += 1
        names, first = parse_round(names, first, round_)
        size = np.diff(first, append=len(names))
        yield round_, np.repeat(text, size), names
        more = size > 1
        if not more.all():
            names = names[np.repeat(more, size)]
            text, size = text[more], size[more]
            first = np.cumsum(size) - size


def fingerprints(texts: list[str], level: int = 3, size: int = 64) -> list[str]:
    """The fingerprint of each text: whole-text name, ``:``, the smallest phrase names, all in hex. Equal texts have equal ones."""
    whole = np.zeros(len(texts), np.uint64)
    keys = []
    for round_, text, names in phrase_names(texts):
        last = np.bincount(text, minlength=len(texts))[text] == 1
        whole[text[last]] = names[last]
        taken = last | (round_ >= level)
        keys.append((text[taken], names[taken] >> np.uint64(64 - _BITS)))
    if not keys:
        return [f"{0:016x}:"] * len(texts)
    text, names = (np.concatenate(x) for x in zip(*keys, strict=True))
    order = np.lexsort((names, text))
    text, names = text[order], names[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (names[1:] != names[:-1])
    text, names = text[fresh], names[fresh]
    start = np.searchsorted(text, np.arange(len(texts) + 1))
    shown = names.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BITS // 8:].tobytes().hex()
    heads = whole.astype(">u8").tobytes().hex()
    return [f"{heads[16 * i:16 * i + 16]}:{shown[_DIGITS * a:_DIGITS * min(b, a + size)]}"
            for i, (a, b) in enumerate(zip(start[:-1].tolist(), start[1:].tolist(), strict=True))]


def likeness(a: str, b: str, size: int = 64) -> float:
    """0 to 1: the share of both texts' phrase names that they have in common; 1 for equal texts, 0 if one is empty."""
    if a == b:
        return 1.0
    one, two = ({x[i:i + _DIGITS] for i in range(17, len(x), _DIGITS)} for x in (a, b))
    if not (both := one & two):
        return 0.0
    union = sorted(one | two)[:size]
    return sum(x <= union[-1] for x in both) / len(union)


def edited(text: str, after: str) -> str:
    """``text`` with its last third of code points replaced by the first as many of ``after``."""
    third = len(text) // 3
    return text[:len(text) - third] + after[:third]


def _pieces(rows: Iterable[tuple], limit: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def document_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", level: int = 3,
                          size: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The documents stand in descending order of ``key``, nulls last, equal keys by the 64-bit hash of
    their text; the first follows the last, so a single row follows itself. ``edited_*`` are those of the text
    with its last third replaced by the beginning of the next document's. near_edited and near_next are the
    likeness of the fingerprint to the edited text's and to the next document's. Null text counts as empty: no
    phrases, the fingerprint of the empty text, likeness 1 to itself and 0 to all others. Repeated rows follow each
    other. Other columns are not read; an empty table gives no rows.

    The texts are dealt out once, by ranges of the order; only each range's first and last rows meet those of
    another.
    """
    key_type = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text").asc()]
    ranged = rows.withColumn("salt", F.rand(0)).repartitionByRange(*order, "salt").drop("salt").sortWithinPartitions(*order)
    arrow = [("id", to_arrow_type(key_type)), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
             ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
             ("kind", pa.string()), ("part", pa.int32()), ("text", pa.string())]
    schema = pa.schema(arrow)
    ddl = (f"id {key_type.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, kind string, part int, text string")

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)],
                                          schema=schema)

    def judged(pairs: list[tuple]) -> list[tuple]:
        """(id, text, fingerprint, next text, next fingerprint) to finished rows."""
        changed = [edited(p[1], p[3]) for p in pairs]
        return [(p[0], len(p[1]), hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), p[2], f,
                 likeness(p[2], f, size), likeness(p[2], p[4], size), "done", None, None)
                for p, t, f in zip(pairs, changed, fingerprints(changed, level, size), strict=True)]

    def run(batches):
        part, last = TaskContext.get().partitionId(), None
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for piece in _pieces(rows, PIECE):
            marks = fingerprints([t for _, t in piece], level, size)
            line = [(*row, mark) for row, mark in zip(piece, marks, strict=True)]
            ends = []
            if last is None:
                ends.append((line[0][0], None, None, line[0][2], None, None, None, "first", part, line[0][1]))
            else:
                line.insert(0, last)
            last = line[-1]
            yield batch(judged([(*a, *b[1:]) for a, b in zip(line, line[1:], strict=False)]) + ends) if len(line) > 1 else batch(ends)
        if last is not None:
            yield batch([(last[0], None, None, last[2], None, None, None, "last", part, last[1])])

    def meet(batches):
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for piece in _pieces(rows, PIECE):
                yield batch(judged(piece))

    found = stored(ranged.mapInArrow(run, ddl), "fingerprints")
    parts = sorted(r.part for r in found.where("kind = 'first'").select("part").collect())  # one number a range
    follows = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, following int")
    ends = found.where("kind = 'last'").select("id", "text", "fingerprint", "part").join(follows, "part").join(
        found.where("kind = 'first'").select(F.col("part").alias("following"), F.col("text").alias("next_text"),
                                             F.col("fingerprint").alias("next_fingerprint")), "following")
    met = ends.select("id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(meet, ddl)
    return found.where("kind = 'done'").unionByName(met).select(
        F.col("id").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
