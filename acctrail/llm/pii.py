"""Personal data: rule spans, and further spans by a skip-chain conditional random field.

The field's nodes are the tokens that hold a digit or an "@" (no kind can do
without one). Neighbouring nodes are linked, and so are distant nodes that
repeat each other (same digits, or same text) or are similar (same shape, and the
same beginning or end): each occurrence with the first one, so that links stay
linear in the text and any two occurrences are at most two links apart. Loopy
belief propagation over the nodes of many texts at once gives the label
marginals; a text takes part until its messages settle. The rule spans of a
bounded sample of texts are the labels it learns from; a share of them loses what
the rule goes by first, so that context and links have to carry the label.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, stored, text_of

KINDS = ["email", "ip", "card", "phone"]
SLOTS = 1 << 14
#: Messages have settled below TOLERANCE; a text that has not by MOST_ROUNDS falls back to its chain of nodes.
TOLERANCE, MOST_ROUNDS = 1e-4, 2000
#: Kinds of links: adjacent nodes, next nodes, repeats, similar tokens.
LINK_KINDS, REPEAT, SIMILAR = 4, 2, 3
#: Similar tokens have this many characters at least, and share this many at an end.
SIMILAR_LENGTH, SIMILAR_END = 7, 4
SPANS = "array<struct<kind: string, start: int, end: int>>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a failed digit run fails from its middle too, so the look-behind only saves time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NODE = re.compile(r"[0-9@]\S*")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    after = 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while m and start > after and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            yield start, m.end()
            after = m.end()
        at = text.find("@", at + 1)


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind; leftmost non-overlapping per kind, failing matches dropped."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _nodes(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or "@", without outer punctuation."""
    out, before = [], 0
    for m in _NODE.finditer(text):
        a, b = m.start(), m.end()
        while a > before and not text[a - 1].isspace():
            a -= 1
        before = b
        while b > a and not text[b - 1].isalnum():
            b -= 1
        while a < b and not (text[a].isalnum() or text[a] in "+(@"):
            a += 1
        if b > a:
            out.append((a, b))
    return out


def _slot(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) % SLOTS


_RUN = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7f]+")


def _node_features(text: str, a: int, b: int) -> list[int]:
    """Slots of the whole token's shape, digits and signs, and of the word at either side (its nearest 24 characters)."""
    token = text[a:b]
    digits = _NOT_DIGIT.sub("", token)
    shape = _RUN.sub(lambda m: "9" * min(len(m[0]), 5) if m[0][0].isdigit() and m[0].isascii() else "a", token)
    left, right = text[max(0, a - 24):a].split(), text[b:b + 24].split()
    near = [_RUN.sub(lambda m: "9" * min(len(m[0]), 5) if m[0].isdigit() else m[0].lower(), (s or [""])[i])
            for s, i in ((left, -1), (right, 0))]
    return [_slot(x) for x in (f"s{shape}", f"n{min(len(digits), 20)}", f"p{token[:1] if not token[:1].isalnum() else 9}",
                               f"d{token.count('.')}@{token.count('@')}-{token.count('-')}", f"l{near[0]}", f"r{near[1]}")]


def _link_keys(token: str) -> list[tuple[int, str]]:
    """(link kind, key): nodes that agree on one are linked by it."""
    digits, low = _NOT_DIGIT.sub("", token), token.lower()
    keys = [(REPEAT, digits if len(digits) >= 7 else low)]
    if len(token) >= SIMILAR_LENGTH:
        shape = _RUN.sub(lambda m: f"9{len(m[0])}" if m[0][0].isdigit() and m[0].isascii() else "a", low)
        keys += [(SIMILAR, f"{shape} {low[:SIMILAR_END]}<"), (SIMILAR, f"{shape} >{low[-SIMILAR_END:]}")]
    return keys


class Field:
    """Nodes, features and links of several texts."""

    def __init__(self, texts: list[str]):
        self.doc, self.span, feats, left, right, kind = [], [], [], [], [], []
        for d, text in enumerate(texts):
            last, seen = None, {}
            for a, b in _nodes(text):
                i = len(self.doc)
                self.doc.append(d)
                self.span.append((a, b))
                feats.append(_node_features(text, a, b))
                if last is not None:
                    left.append(last)
                    right.append(i)
                    kind.append(0 if a - self.span[last][1] <= 2 else 1)
                partners = {i, last}
                for key in _link_keys(text[a:b]):
                    first = seen.setdefault(key, i)
                    if first not in partners:
                        partners.add(first)
                        left.append(first)
                        right.append(i)
                        kind.append(key[0])
                last = i
        self.feats = np.array(feats, np.int64).reshape(-1, 6)
        self.left, self.right, self.kind = (np.array(x, np.int64) for x in (left, right, kind))

    def messages(self) -> tuple[np.ndarray, np.ndarray]:
        """Uniform messages of the links, to the right and to the left."""
        return np.full((len(self.left), 5), 0.2), np.full((len(self.left), 5), 0.2)


@dataclass
class PiiModel:
    unary: np.ndarray     #: slot x label; label 0 is "none", then KINDS
    pair: np.ndarray      #: link kind (adjacent, next, repeat, similar) x label x label

    def beliefs(self, field: Field, rounds: int | None = None, messages: tuple[np.ndarray, np.ndarray] | None = None,
                links: bool = True):
        """Label marginals of nodes and (with ``links``, else None) of links by loopy belief propagation.

        Each text goes on until its messages settle, for at most ``rounds``
        rounds (None: enough for its longest chain of nodes, there and back).
        A text still moving then (``rounds`` None only) goes on without its repeat and
        similar links: what is left is a chain, whose messages settle.
        ``messages`` are started from and updated in place.
        """
        u = self.unary[field.feats].sum(1)
        n, e = len(u), len(field.left)
        psi = np.exp(self.pair)[field.kind]
        to_right, to_left = messages or field.messages()
        doc = np.array(field.doc, np.int64)
        nodes = np.bincount(doc)
        text = doc[field.left] if e else np.zeros(0, np.int64)
        limit = min(12 + 2 * int(nodes.max(initial=0)), MOST_ROUNDS) if rounds is None else rounds

        def settle(live, limit, keep):
            """The links still moving after ``limit`` rounds; ``keep`` is the old messages' part in new ones."""
            for _ in range(limit):
                if not len(live):
                    break
                left, right, old_right, old_left = field.left[live], field.right[live], to_right[live], to_left[live]
                log_right, log_left = np.log(old_right), np.log(old_left)
                total = u.copy()
                np.add.at(total, right, log_right)
                np.add.at(total, left, log_left)
                a, b = total[left] - log_left, total[right] - log_right
                a, b = (np.exp(x - x.max(1, keepdims=True)) for x in (a, b))
                new_right = np.einsum("ei,eij->ej", a, psi[live])
                new_left = np.einsum("ej,eij->ei", b, psi[live])
                new_right /= new_right.sum(1, keepdims=True)
                new_left /= new_left.sum(1, keepdims=True)
                change = np.maximum(np.abs(new_right - old_right).max(1), np.abs(new_left - old_left).max(1))
                to_right[live], to_left[live] = (np.maximum(keep * x + (1 - keep) * y, 1e-9)
                                                 for x, y in ((old_right, new_right), (old_left, new_left)))
                moving = np.zeros(len(nodes), bool)
                moving[text[live][change >= TOLERANCE]] = True
                live = live[moving[text[live]]]
            return live

        live = settle(np.arange(e), limit, 0.5)
        if rounds is None and len(live):
            skip = field.kind[live] >= REPEAT
            to_right[live[skip]] = to_left[live[skip]] = 0.2
            # undamped messages of a chain are exact after as many rounds as it has links
            settle(live[~skip], int(nodes.max()), 0.0)
        total = u.copy()
        np.add.at(total, field.right, np.log(to_right))
        np.add.at(total, field.left, np.log(to_left))
        p = np.exp(total - total.max(1, keepdims=True)) if n else total
        p /= p.sum(1, keepdims=True)
        if not links:
            return p, None
        a, b = total[field.left] - np.log(to_left), total[field.right] - np.log(to_right)
        a, b = (np.exp(x - x.max(1, keepdims=True)) if e else x for x in (a, b))
        joint = a[:, :, None] * psi * b[:, None, :]
        return p, joint / np.maximum(joint.sum((1, 2), keepdims=True), 1e-300)


def _hidden(text: str) -> tuple[str, list[tuple[int, int, int]]]:
    """The text and its rule spans, every second phone and email span without what its rule goes by.

    A phone number loses its "+", an address all of its domain but the first name. Which ones is
    settled by their own text, so repeats are hidden alike.
    """
    spans, out, kept, at = rule_spans(text), [], [], 0
    size = 0
    for a, k, b in spans:
        if a < at:  # overlaps another kind: left as it is
            continue
        value = text[a:b]
        if KINDS[k] in ("phone", "email") and zlib.crc32(value.encode("utf-8", "surrogatepass")) >> 4 & 1:
            value = value[1:] if KINDS[k] == "phone" else value[:value.index(".", value.index("@"))]
        out += [text[at:a], value]
        size += a - at
        kept.append((size, k, size + len(value)))
        size += len(value)
        at = b
    return "".join([*out, text[at:]]), kept


def _labels(field: Field, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Label of each node: the first of its text's spans that touches it."""
    out = np.zeros(len(field.doc), np.int64)
    doc = np.array(field.doc, np.int64)
    for d, own in enumerate(spans):
        lo, hi = np.searchsorted(doc, [d, d + 1])
        at = lo
        for a, k, b in own:
            while at < hi and field.span[at][1] <= a:
                at += 1
            for i in range(at, hi):
                if field.span[i][0] >= b:
                    break
                out[i] = out[i] or k + 1
    return out


@dataclass
class Examples:
    """Nodes, links and labels of the texts that the field learns from; all a step needs of a :class:`Field`."""

    doc: np.ndarray
    feats: np.ndarray
    left: np.ndarray
    right: np.ndarray
    kind: np.ndarray
    y: np.ndarray
    messages = Field.messages

    @classmethod
    def of(cls, texts: list[str]) -> Examples:
        hidden = [_hidden(t) for t in texts]
        field = Field([t for t, _ in hidden])
        return cls(np.array(field.doc, np.int64), field.feats, field.left, field.right, field.kind,
                   _labels(field, [spans for _, spans in hidden]))

    @classmethod
    def joined(cls, parts: list[Examples]) -> Examples:
        """Parts of one text each."""
        first = np.cumsum([0, *(len(p.y) for p in parts)])
        none = np.zeros(0, np.int64)
        return cls(np.repeat(np.arange(len(parts)), np.diff(first)),
                   np.concatenate([np.zeros((0, 6), np.int64), *(p.feats for p in parts)]),
                   *(np.concatenate([none, *(getattr(p, c) + n for p, n in zip(parts, first[:-1], strict=True))]) for c in ("left", "right")),
                   *(np.concatenate([none, *(getattr(p, c) for p in parts)]) for c in ("kind", "y")))


def fit_field(texts: list[str], steps: int = 60, rate: float = 0.4, l2: float = 1e-3) -> PiiModel:
    """:func:`fit_examples` on whole texts."""
    return fit_examples(Examples.of(texts), steps, rate, l2)


def fit_examples(field: Examples, steps: int = 60, rate: float = 0.4, l2: float = 1e-3) -> PiiModel:
    """Weights by gradient steps: observed minus expected counts under loopy marginals."""
    y = field.y
    model = PiiModel(np.zeros((SLOTS, 5)), np.zeros((LINK_KINDS, 5, 5)))
    n = len(y)
    if not n:
        model.unary[:, 0] = 1
        return model
    used, slot = np.unique(field.feats, return_inverse=True)
    slot = slot.reshape(field.feats.shape)
    gu, gp = np.zeros((len(used), 5)), np.zeros((LINK_KINDS, 5, 5))
    truth = np.eye(5)[y]
    # messages go on from step to step, so they follow the weights over any distance
    messages = field.messages()
    for _ in range(steps):
        p, joint = model.beliefs(field, 6, messages)
        grad = np.zeros((len(used), 5))
        for c in range(field.feats.shape[1]):
            np.add.at(grad, slot[:, c], truth - p)
        grad -= l2 * n * 0.01 * model.unary[used]
        pair = np.zeros((LINK_KINDS, 5, 5))
        np.add.at(pair, (field.kind, y[field.left], y[field.right]), 1)
        np.add.at(pair, field.kind, -joint)
        pair -= l2 * n * model.pair
        gu += grad ** 2
        gp += pair ** 2
        model.unary[used] += rate * grad / (np.sqrt(gu) + 1e-6)
        model.pair += 0.2 * rate * pair / (np.sqrt(gp) + 1e-6)
    return model


def train_pii(docs: DataFrame, sample_rows: int = 20_000, node_limit: int = 40_000, text_nodes: int = 2_000) -> PiiModel:
    """Learn from the rule spans of the ``sample_rows`` ids with the smallest hash.

    Their texts are taken whole, in the order of the hash, until ``node_limit``
    nodes are used; texts of more than ``text_nodes`` nodes are passed over, so that no single
    text makes up the sample. The driver gets numbers only (about
    70 bytes a node and 24 a link). Null texts count as empty; rows with a null doc_id are not
    drawn, and of rows repeated under one doc_id one is. Without nodes, the model labels
    nothing. Other columns are not read. Runs jobs.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    sample = hash_sample(base.where(F.col("text").rlike("[0-9@]")), "doc_id", sample_rows, "pii-sample")
    arrays = ["feats", "left", "right", "kind", "y"]

    def encode(batches):
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                found = Examples.of([text])
                if 0 < len(found.y) <= text_nodes:
                    rows.append((doc_id, len(found.y), *(getattr(found, c).tobytes() for c in arrays)))
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "nodes", *arrays])

    encoded = stored(sample.mapInPandas(encode, "doc_id long, nodes int, " + ", ".join(f"{c} binary" for c in arrays)), "pii-nodes")
    place = F.xxhash64("doc_id").alias("place")
    # at most sample_rows rows of three numbers; the texts drawn are those up to a place in the order
    used, last = 0, None
    for r in sorted(encoded.select(place, "doc_id", "nodes").collect()):
        used += r["nodes"]
        if used > node_limit:
            break
        last = r
    rows = []
    if last:
        upto = (F.col("place") < last["place"]) | ((F.col("place") == last["place"]) & (F.col("doc_id") <= last["doc_id"]))
        rows = sorted(encoded.select(place, "*").where(upto).collect())
    parts = []
    for r in rows:
        feats, *rest = (np.frombuffer(r[c], np.int64) for c in arrays)
        parts.append(Examples(np.zeros(r["nodes"], np.int64), feats.reshape(-1, 6), *rest))
    return fit_examples(Examples.joined(parts))


def _all_spans(texts: list[str], model: PiiModel, threshold: float):
    base = [rule_spans(t) for t in texts]
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    field = Field(texts)
    if len(field.doc):
        start = [np.array([a for a, _, _ in x], np.int64) for x in base]
        reach = [np.maximum.accumulate(np.array([b for _, _, b in x], np.int64)) if x else None for x in base]
        p, _ = model.beliefs(field, links=False)
        best = p[:, 1:].argmax(1)
        for i in np.flatnonzero(p[np.arange(len(p)), best + 1] >= threshold).tolist():
            d, (a, b), k = field.doc[i], field.span[i], int(best[i])
            before = int(np.searchsorted(start[d], b))
            if before and reach[d][before - 1] > a:
                continue
            own = added[d]
            if own and own[-1][1] == k and a - own[-1][2] <= 2 and field.doc[i - 1] == d and field.span[i - 1][1] == own[-1][2]:
                own[-1] = (own[-1][0], k, b)
            else:
                own.append((a, k, b))
    return base, added


def find_pii(docs: DataFrame, model: PiiModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, text, ``base`` (rule spans) and ``spans`` (these and the field's), sorted by start and kind.

    Offsets are code points, end exclusive. The field adds runs of nodes of one
    kind whose marginal reaches ``threshold`` and that no rule span touches.
    Null text counts as empty; null doc_ids and repeated rows stay; other
    columns are not read.
    """
    def named(spans):
        return [(KINDS[k], a, b) for a, k, b in spans]

    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            base, added = [], []
            at = size = 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= 1 << 20 or i == len(texts) - 1:
                    x, y = _all_spans(texts[at:i + 1], model, threshold)
                    base += x
                    added += y
                    at, size = i + 1, 0
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "text": pdf["text"], "base": [named(x) for x in base],
                                "spans": [named(sorted(x + y)) for x, y in zip(base, added, strict=True)]})

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return base.mapInPandas(run, f"doc_id long, text string, base {SPANS}, spans {SPANS}")


def masked_column(text: Column, model: PiiModel, threshold: float = 0.5) -> Column:
    """The text with every rule span and field span replaced by its upper-case kind in angle brackets; null stays null.

    Overlapping spans are replaced once, as the kind that starts first.
    """
    def mask(text, spans):
        out, at = [], 0
        for a, k, b in spans:
            if a >= at:
                out += [text[at:a], f"<{KINDS[k].upper()}>"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    @F.pandas_udf("string")
    def column(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if not isinstance(t, str):
                out.append(None)
                continue
            base, added = _all_spans([t], model, threshold)
            out.append(mask(t, sorted(base[0] + added[0])))
        return pd.Series(out, dtype=object)

    return column(text)


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
