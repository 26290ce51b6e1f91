"""Exact Jaccard join on word shingles through an R-tree over count vectors.

1. Each text becomes the set of its word k-shingles (64-bit hashes). Texts with
   equal sets form one class with a 128-bit key; later steps see classes.
2. A class is a point: shingles are hashed into G groups (a power of two of at
   least 64 and about an eighth of the set) and counted. Folding halves G, so
   any two points can be compared at the smaller G.
3. Each point gets one more coordinate, its region: linked points always share
   one, and most points share theirs with few others or none (these go no
   further). The range of shingle hashes is cut into p parts; a token is a part
   with the set's shingles in it. Linked sets differ in at most d shingles, so
   at least p - d of their tokens are equal. With all tokens in one order, the
   first equal one is among the first d + 1 of both sets. These are dealt out
   by hash, and classes that meet in a token are connected to one region. Any
   order is exact; tokens with many rare shingles come first, so that few other
   sets share them. p follows the larger size in powers of two; a set also takes
   the parts of the next powers that its partners may have.
4. The points are packed into R-tree leaves by a range shuffle over (region, size
   band, signs of eight coarse coordinates). A leaf is one row with its bounding
   box; FAN neighbours get a parent box, and so on up to one root. Pairs of boxes
   are followed down from the root, level by level, as long as they have regions
   in common and the summed coordinate minima of two boxes can reach the overlap
   that the threshold asks for.
5. Inside a leaf pair the same bound (sum of coordinate minima) is applied to
   points of one region, first on 8, then 64, then G coordinates. Survivors only
   matter as candidate groups, so a task emits a spanning set of links, not all pairs.
6. Texts of candidate groups are fetched once; each group is cut into blocks of
   bounded size and every block pair verifies its pairs on exact sets, skipping
   pairs that are already connected. No pair of points with the asked overlap
   fails the bound, so no link between components is lost.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, rows_a_batch, stored, text_of, unused
from .graph import Forest, components
from .textarrays import Words, as_bytes, chunks, mix, signed, span_hash

LEAF_ROWS, LEAF_BYTES = 2048, 4 << 20
FAN = 16
BLOCK_SHINGLES = 4_000_000
#: rows that a Python worker gets at a time
BATCH_ROWS = 2000
#: shingles whose tokens meet in one bucket, bytes of tokens dealt out at a time
BUCKET_SHINGLES, DEAL_BYTES = 1_000_000, 8 << 20
#: a shingle is common if so many texts have it, of one text in COMMON_OF; at most COMMON_MOST are
COMMON_OF, COMMON_TEXTS, COMMON_MOST = 32, 3, 1 << 20
_BASE = 0xC2B2AE3D27D4EB4F
_SECOND = np.uint64(0xA0761D6478BD642F)
_THIRD = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(part: list[bytes], k: int):
    """Distinct shingle hashes of each text: (values, offsets), sorted inside a text."""
    w = Words([t.lower() for t in part])
    sums = w.sums(_BASE)
    start, gram = w.grams(k, sums, _BASE)
    few = np.flatnonzero((w.count > 0) & (w.count < k))
    doc = np.concatenate([w.doc[start], few])
    gram = np.concatenate([gram, span_hash(sums, _BASE, w.first[few], w.first[few] + w.count[few])])
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        doc, gram = doc[new], gram[new]
    return gram, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(part)))))


def _class_keys(gram: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    out = []
    sums = [np.concatenate(([np.uint64(0)], np.cumsum(mix(gram ^ c), dtype=np.uint64)))
            for c in (np.uint64(0x5851F42D4C957F2D), _SECOND)]
    size = np.diff(offsets).astype(np.uint64)
    pair = np.stack([mix(s[offsets[1:]] - s[offsets[:-1]] + size) for s in sums], axis=1)
    for row in pair:
        out.append(row.tobytes())
    return out


def _groups(n: int) -> int:
    return max(64, 1 << max(0, (max(n, 1) // 8 - 1).bit_length()))


def _grams(k: int):
    def run(batches):
        for pdf in batches:
            for _, part in chunks(as_bytes(pdf["text"])):
                yield pd.DataFrame({"gram": signed(shingle_sets(part, k)[0])})
    return run


def _common(base: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of common shingles. They only order tokens: links are the same with any list."""
    texts = base.where(F.pmod("text_id", F.lit(COMMON_OF)) == 0).dropDuplicates(["text_id"]).select("text")
    found = (texts.mapInPandas(lean(_grams(k)), "gram long").groupBy("gram").count().where(F.col("count") >= COMMON_TEXTS)
             .orderBy(F.desc("count"), "gram").limit(COMMON_MOST).select("gram").toPandas())
    return np.sort(found["gram"].to_numpy(np.int64).view(np.uint64))


def _apart(x: int, y: int, num: int, den: int) -> int:
    """Shingles that are in one of two linked sets of sizes x and y only, at most."""
    return (x + y) * (den - num) // (den + num)


def _parts(top: int, num: int, den: int) -> int:
    """Parts for pairs of sets of which the larger has fewer than ``top`` shingles; more than they can differ in."""
    return 7 * (_apart(top - 1, top - 1, num, den) + 1) // 5 + 4


def _tokens(gram: np.ndarray, offsets: np.ndarray, num: int, den: int, common: np.ndarray) -> list[bytes]:
    """Hashes of the tokens by which each set meets those it may link with; none for sets too small for links."""
    least = -(-num // (den - num))
    rare = np.ones(len(gram), np.int64)
    if len(common):
        rare[common[np.minimum(np.searchsorted(common, gram), len(common) - 1)] == gram] = 0
    rare = np.concatenate(([0], np.cumsum(rare)))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(gram ^ _THIRD), dtype=np.uint64)))
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        n, found = b - a, []
        high, most = gram[a:b] >> np.uint64(32), n * den // num
        low = 1 << max(0, n.bit_length() - 1)
        while n >= least and low <= most:
            top, p = 2 * low, _parts(2 * low, num, den)
            part = (high * np.uint64(p) >> np.uint64(32)).astype(np.int64)
            cut = a + np.searchsorted(part, np.arange(p + 1))
            place = (np.arange(p, dtype=np.uint64) << np.uint64(8)) + np.uint64(top.bit_length())
            token = mix(mix(sums[cut[1:]] - sums[cut[:-1]]) + mix(place))
            first = np.lexsort((token, cut[:-1] - cut[1:], rare[cut[:-1]] - rare[cut[1:]]))
            found.append(token[first[:_apart(n, min(most, top - 1), num, den) + 1]])
            low = top
        out.append(np.concatenate(found).tobytes() if found else b"")
    return out


def _deal(buckets: int):
    """Rows (bucket, tokens, ids): the tokens of many classes, cut by ranges of the hash."""
    def dealt(ids, tokens):
        ids = np.repeat(np.array(ids, np.int64), [len(t) // 8 for t in tokens])
        token = np.frombuffer(b"".join(tokens), np.uint64)
        order = np.argsort(token)
        token, ids = token[order], ids[order]
        bucket = ((token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cut = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
        full = [(i, a, b) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
        return pd.DataFrame({"bucket": [i for i, _, _ in full], "tokens": [token[a:b].tobytes() for _, a, b in full],
                             "ids": [ids[a:b].tobytes() for _, a, b in full]})

    def run(batches):
        ids, tokens, size = [], [], 0
        for pdf in batches:
            for i, t in zip(pdf["id"].tolist(), pdf["tokens"], strict=True):
                ids.append(i)
                tokens.append(t)
                size += len(t)
                if size >= DEAL_BYTES:
                    yield dealt(ids, tokens)
                    ids, tokens, size = [], [], 0
        if ids:
            yield dealt(ids, tokens)
    return run


def _meet(pdf):
    """Each id of a token linked with the token's smallest id."""
    token = np.frombuffer(b"".join(pdf["tokens"]), np.uint64)
    ids = np.frombuffer(b"".join(pdf["ids"]), np.int64)
    order = np.lexsort((ids, token))
    token, ids = token[order], ids[order]
    new = np.concatenate(([True], token[1:] != token[:-1]))
    least = ids[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return pd.DataFrame({"a": least, "b": ids})[least != ids].drop_duplicates()


def _regions(rows: DataFrame) -> DataFrame:
    """(id, region) of the classes that share a token with another; linked classes have one region."""
    rows = rows.where(F.length("tokens") > 0).select("id", "n", "tokens")
    buckets = 1 + (rows.agg(F.sum("n")).first()[0] or 0) // BUCKET_SHINGLES
    links = (rows.select("id", "tokens").mapInPandas(lean(_deal(buckets)), "bucket long, tokens binary, ids binary")
             .groupBy("bucket").applyInPandas(_meet, "a long, b long"))
    return components(links).select(F.col("node").alias("id"), F.col("root").alias("region"))


def _points(k: int, num: int, den: int, common: np.ndarray):
    def run(batches):
        for pdf in batches:
            texts = as_bytes(pdf["text"])
            for at, part in chunks(texts):
                gram, off = shingle_sets(part, k)
                size = np.diff(off)
                vec = [np.bincount((gram[a:b] & np.uint64(_groups(b - a) - 1)).astype(np.int64),
                                   minlength=_groups(b - a)).astype(np.uint16).tobytes()
                       for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                rows, cls = pdf.iloc[at:at + len(part)], _class_keys(gram, off)
                yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "doc": rows["doc"].to_numpy(),
                                    "text_id": rows["text_id"].to_numpy(), "cls": cls, "id": np.frombuffer(b"".join(cls), np.int64)[::2],
                                    "n": size.astype(np.int64), "vec": vec, "tokens": _tokens(gram, off, num, den, common)})
    return run


def _folded(vecs: list[bytes], groups: int) -> np.ndarray:
    out = np.empty((len(vecs), groups), np.int32)
    for i, v in enumerate(vecs):
        out[i] = np.frombuffer(v, np.uint16).reshape(-1, groups).sum(0)
    return out


def _pack(most_rows: int, most_bytes: int):
    """Cut each partition's sorted points into leaves with bounding boxes."""
    def run(batches):
        from pyspark import TaskContext
        pid, at = TaskContext.get().partitionId() << 24, 0

        def leaf(rows):
            nonlocal at
            box = _folded(rows["vec"].tolist(), 64)
            at += 1
            return {"leaf": pid + at, "region_lo": int(rows["region"].min()), "region_hi": int(rows["region"].max()), "n_lo": int(rows["n"].min()), "n_hi": int(rows["n"].max()),
                    "lo": box.min(0).tolist(), "hi": box.max(0).tolist(), "keys": b"".join(rows["cls"]),
                    "regions": rows["region"].to_numpy(np.int64).tobytes(),
                    "sizes": rows["n"].to_numpy(np.int64).tobytes(), "vecs": b"".join(rows["vec"])}

        held = None
        for pdf in batches:
            pdf = pdf[["region", "cls", "n", "vec"]]
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            held, out = None, []
            weight = np.cumsum(pdf["vec"].map(len).to_numpy())
            a = 0
            while a < len(pdf):
                limit = (weight[a - 1] if a else 0) + most_bytes
                b = max(a + 1, min(a + most_rows, int(np.searchsorted(weight, limit, "right"))))
                if b >= len(pdf):
                    held = pdf.iloc[a:].reset_index(drop=True)
                    break
                out.append(leaf(pdf.iloc[a:b]))
                a = b
            if out:
                yield pd.DataFrame(out)
        if held is not None:
            yield pd.DataFrame([leaf(held)])
    return run


class _Points:
    """Points of one side, by region and size."""

    def __init__(self, keys, sizes, vecs, regions=None):
        if regions is None:
            regions = np.zeros(len(sizes), np.int64)
        order = np.lexsort((sizes, regions))
        self.n, self.region = sizes[order], regions[order]
        self.keys = [keys[i] for i in order]
        self.vecs = [vecs[i] for i in order]
        self.c64 = _folded(self.vecs, 64)
        self.c8 = self.c64.reshape(-1, 8, 8).sum(1)

    @classmethod
    def unpacked(cls, keys, sizes, vecs, regions):
        sizes = np.frombuffer(sizes, np.int64)
        keys = [keys[i:i + 16] for i in range(0, len(keys), 16)]
        cut = np.concatenate(([0], np.cumsum([2 * _groups(n) for n in sizes.tolist()])))
        return cls(keys, sizes, [vecs[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)],
                   np.frombuffer(regions, np.int64))


def _near(a: _Points, i: int, b: _Points, num: int, den: int, labels: np.ndarray, own: int) -> np.ndarray:
    """Indices in b, of a's region i and other labels than ``own``, whose summed coordinate minima with a's point i reach the overlap.

    Overlap o of sizes x, y meets den * o >= num * (x + y - o). The sum of
    minima is (x + y - L1) / 2, so the bound is L1 * (den + num) <= (x + y) * (den - num).
    """
    n = int(a.n[i])
    at, end = (np.searchsorted(b.region, a.region[i], side) for side in ("left", "right"))
    lo = at + np.searchsorted(b.n[at:end], -(-n * num // den), "left")
    hi = at + np.searchsorted(b.n[at:end], n * den // num, "right")
    js = lo + np.flatnonzero(labels[lo:hi] != own)
    for side in ("c8", "c64"):
        if not len(js):
            return js
        l1 = np.abs(getattr(b, side)[js] - getattr(a, side)[i]).sum(1)
        js = js[l1 * (den + num) <= (b.n[js] + n) * (den - num)]
    if not len(js) or len(a.vecs[i]) <= 128:
        return js
    kept = []
    for j in js.tolist():
        g = min(len(a.vecs[i]), len(b.vecs[j])) // 2
        l1 = int(np.abs(_folded([a.vecs[i]], g) - _folded([b.vecs[j]], g)).sum())
        if l1 * (den + num) <= (n + int(b.n[j])) * (den - num):
            kept.append(j)
    return np.array(kept, np.int64)


class _Labels:
    """Connected labels of the rows of two sides, as one array."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, x: int, y: int) -> bool:
        a, b = self.of[x], self.of[y]
        if a == b:
            return False
        self.of[self.of == max(a, b)] = min(a, b)
        return True


def _candidates(num: int, den: int):
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                a = _Points.unpacked(row.keys_a, row.sizes_a, row.vecs_a, row.regions_a)
                same = row.leaf_a == row.leaf_b
                b = a if same else _Points.unpacked(row.keys_b, row.sizes_b, row.vecs_b, row.regions_b)
                shift = 0 if same else len(a.n)
                labels = _Labels(len(a.n) + (0 if same else len(b.n)))
                links = []
                of_b = labels.of[shift:shift + len(b.n)]
                for i in np.flatnonzero(np.isin(a.region, b.region)).tolist():
                    for j in _near(a, i, b, num, den, of_b, labels.of[i]).tolist():
                        if labels.join(i, shift + j):
                            links.append((int(a.region[i]), a.keys[i], b.keys[j]))
                if links:
                    yield pd.DataFrame(links, columns=["region", "a", "b"])
    return run


def _groups_of(pdf):
    """(node, root) for every node of one region's links; root is the smallest node of its group."""
    at, nodes = pd.factorize(pd.concat([pdf["a"], pdf["b"]], ignore_index=True), sort=True)
    forest = Forest(len(nodes))
    for x, y in zip(at[:len(pdf)].tolist(), at[len(pdf):].tolist(), strict=True):
        forest.union(x, y)
    return pd.DataFrame({"node": nodes, "root": [nodes[forest.find(i)] for i in range(len(nodes))]})


def _fetch(k: int):
    """Texts of candidate classes to sorted shingle arrays; a text of another class under the same id goes."""
    def run(batches):
        for pdf in batches:
            texts = as_bytes(pdf["text"])
            for at, part in chunks(texts):
                gram, off = shingle_sets(part, k)
                keys = _class_keys(gram, off)
                rows = [(pdf["cls"].iat[at + i], pdf["root"].iat[at + i], gram[off[i]:off[i + 1]].tobytes())
                        for i in range(len(part)) if keys[i] == bytes(pdf["cls"].iat[at + i])]
                if rows:
                    yield pd.DataFrame(rows, columns=["cls", "root", "grams"])
    return run


def _verify(num: int, den: int):
    def run(key, pdf):
        grams = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
        size = np.array([len(g) for g in grams], np.int64)
        blk = pdf["blk"].to_numpy()
        keys, links = pdf["cls"].tolist(), []
        cross = key[1] != key[2]
        left = np.flatnonzero(blk == key[1])
        right = np.flatnonzero(blk == key[2])

        def points(ids):
            vecs = [np.bincount((grams[i] & np.uint64(_groups(len(grams[i])) - 1)).astype(np.int64),
                                minlength=_groups(len(grams[i]))).astype(np.uint16).tobytes() for i in ids]
            return _Points(list(ids), size[ids], vecs)

        a = points(left)
        b = points(right) if cross else a
        at_b = np.array(b.keys, np.int64)
        labels = _Labels(len(pdf))
        for i, row in enumerate(a.keys):
            for j in _near(a, i, b, num, den, labels.of[at_b], labels.of[row]).tolist():
                other = b.keys[j]
                if labels.of[row] == labels.of[other]:
                    continue
                x, y = grams[row], grams[other]
                both = len(x) + len(y) - len(np.union1d(x, y))
                if den * both >= num * (len(x) + len(y) - both):
                    labels.join(row, other)
                    links.append((keys[row], keys[other]))
        return pd.DataFrame(links, columns=["a", "b"])
    return run


def jaccard_components(docs: DataFrame, k: int = 5, similarity: Fraction = Fraction(80, 100)) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A-Z are lower-cased and words are runs of anything but space and
    0x09-0x0D. The set of a text is its distinct k-word shingles; the whole
    sequence if it has fewer words. Texts link when the Jaccard similarity of
    their sets is at least ``similarity``; component_id is the smallest doc_id
    reachable by links.

    Null texts and texts without words have an empty set, link with nothing
    and are their own component. Rows with a null doc_id take part, but never
    name a component unless all its ids are null (then component_id is null).
    Repeated rows and different texts under one doc_id are rows of their own.
    Other columns of ``docs`` are not read. Runs jobs (see ``common.stored``).
    """
    with rows_a_batch(docs.sparkSession, BATCH_ROWS):
        joined = _joined(docs, k, similarity)
    return joined.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = 5, similarity: Fraction = Fraction(80, 100)) -> DataFrame:
    """``docs`` with one row of each component of :func:`jaccard_components`, all columns kept.

    The row with the smallest (doc_id, hash of the text) stays; a null doc_id comes after all others.
    Texts without words are no duplicates of each other, but rows equal in
    doc_id and text are one.
    """
    with rows_a_batch(docs.sparkSession, BATCH_ROWS):
        joined = _joined(docs, k, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id", "doc")
    first = (joined.where("n > 0").groupBy("root").agg(F.min(place).alias("p")).select("p.doc", "p.text_id")
             .unionByName(joined.where("n = 0").select("doc", "text_id").distinct()))
    text = text_of(docs)
    key, text_id = unused(docs, "_jaccard_doc"), unused(docs, "_jaccard_text")
    keyed = docs.withColumn(text_id, F.xxhash64(F.lit(1), text)).withColumn(
        key, F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)))
    first = first.select(F.col("doc").alias(key), F.col("text_id").alias(text_id))
    return keyed.join(first, [key, text_id], "left_semi").dropDuplicates([key, text_id]).select(*docs.columns)


def _joined(docs: DataFrame, k: int, similarity: Fraction) -> DataFrame:
    """doc_id, doc, text_id, n, root, component_id of every row; root names the component of rows with n > 0.

    All Python steps have run when it returns.
    """
    num, den = similarity.numerator, similarity.denominator
    least = -(-num // (den - num))  # a link between different sets needs den*o >= num*u with u > o
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    base = (base.withColumn("doc", F.coalesce("doc_id", F.xxhash64("text")))
            .withColumn("text_id", F.xxhash64(F.lit(1), "text")))
    rows = base.mapInPandas(lean(_points(k, num, den, _common(base, k))), "doc_id long, doc long, text_id long, cls binary, "
                            "id long, n long, vec binary, tokens binary")
    rows = stored(rows, "points")
    classes = stored(rows.where("n > 0").groupBy("cls")
                     .agg(F.min("doc_id").alias("rep"), F.min("doc").alias("doc"), F.first("id").alias("id"),
                          F.first("n").alias("n"), F.first("vec").alias("vec")), "classes")

    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(den / num)))
    points = (classes.where(F.col("n") >= least).join(_regions(rows), "id")
              .select("region", "cls", "n", "vec", band.alias("band")))
    points = stored(points.mapInPandas(_with_sign, "region long, cls binary, n long, vec binary, band long, sign int"), "regions")
    order = ["region", "band", "sign", "n", "cls"]
    leaves = stored(points.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInPandas(_pack(LEAF_ROWS, LEAF_BYTES), "leaf long, region_lo long, region_hi long, n_lo long, n_hi long, "
                                        "lo array<int>, hi array<int>, keys binary, regions binary, sizes binary, vecs binary"), "leaves")
    pairs = _leaf_pairs(leaves, num, den)

    def side(s):
        return leaves.select(*(F.col(c).alias(f"{c}_{s}") for c in ("leaf", "keys", "regions", "sizes", "vecs")))

    links = (pairs.join(side("a"), "leaf_a").join(side("b"), "leaf_b")
             .mapInPandas(lean(_candidates(num, den)), "region long, a binary, b binary"))
    # links never leave a region, so one pass over each finds its groups
    groups = links.groupBy("region").applyInPandas(_groups_of, "node binary, root binary")

    wanted = (groups.join(classes.select(F.col("cls").alias("node"), "doc", "n"), "node")
              .select(F.col("node").alias("cls"), "root", "doc", "n"))
    wanted = stored(wanted, "wanted")
    # wanted grows with the corpus, so it is never broadcast: the plan is the same at every size
    sets = (base.join(wanted.select("cls", "root", "doc").hint("merge"), "doc").select("cls", "root", "text")
            .mapInPandas(lean(_fetch(k)), "cls binary, root binary, grams binary").dropDuplicates(["cls"]))
    blocks = wanted.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    sets = (sets.join(blocks, "root")
            .withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("blocks").cast("long")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo_blk", F.least("blk", "other")).withColumn("hi_blk", F.greatest("blk", "other")))
    verified = (sets.select("cls", "grams", "blk", "root", "lo_blk", "hi_blk")
                .groupBy("root", "lo_blk", "hi_blk").applyInPandas(_verify(num, den), "a binary, b binary"))
    linked = components(verified)

    class_root = (classes.select("cls", "rep").join(linked.withColumnRenamed("node", "cls"), "cls", "left")
                  .select("cls", "rep", F.coalesce("root", "cls").alias("root")))
    named = class_root.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = class_root.join(named, "root").select("cls", "root", "component_id")
    columns = ["doc_id", "doc", "text_id", "n", "root", "component_id"]
    full = rows.where("n > 0").join(named, "cls").select(*columns)
    empty = (rows.where("n = 0").withColumn("root", F.lit(None).cast("binary"))
             .withColumn("component_id", F.col("doc_id")).select(*columns))
    return full.unionByName(empty)


def _with_sign(batches):
    """Which of eight coarse coordinates lie above their mean: near points mostly agree."""
    for pdf in batches:
        if len(pdf):
            c8 = _folded(pdf["vec"].tolist(), 64).reshape(-1, 8, 8).sum(1)
            above = c8 * 8 > pdf["n"].to_numpy()[:, None]
            pdf["sign"] = (above * (1 << np.arange(8))).sum(1).astype(np.int32)
            yield pdf


def _tree(leaves: DataFrame) -> list[DataFrame]:
    """Boxes by level: leaves first, then parents of FAN neighbours in the order of the range shuffle, up to one root.

    A row is (node, region_lo, region_hi, n_lo, n_hi, lo, hi); a node's parent is node // FAN. The driver sees two
    numbers, the most leaves of a partition and the last partition; a level is 1/FAN of the one below. Leaves
    without regions are all of one.
    """
    if "region_lo" not in leaves.columns:
        leaves = leaves.withColumns({"region_lo": F.lit(0), "region_hi": F.lit(0)})
    at, part = F.col("leaf").bitwiseAND((1 << 24) - 1), F.shiftright("leaf", 24)
    most, last = leaves.agg(F.max(at), F.max(part)).first()
    if most is None:
        return []
    room = FAN
    while room <= most:
        room *= FAN
    level = leaves.select((part * room + at).alias("node"), "leaf", "region_lo", "region_hi", "n_lo", "n_hi", "lo", "hi")
    levels, ends = [level], (last + 1) * room
    none = F.array_repeat(F.lit(2**31 - 1), 64), F.array_repeat(F.lit(0), 64)
    while ends > 1:
        level = level.groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(
            F.min("region_lo").alias("region_lo"), F.max("region_hi").alias("region_hi"), F.min("n_lo").alias("n_lo"), F.max("n_hi").alias("n_hi"),
            F.reduce(F.collect_list("lo"), none[0], lambda s, x: F.zip_with(s, x, lambda u, v: F.least(u, v))).alias("lo"),
            F.reduce(F.collect_list("hi"), none[1], lambda s, x: F.zip_with(s, x, lambda u, v: F.greatest(u, v))).alias("hi"))
        levels.append(stored(level, "boxes"))
        level, ends = levels[-1], -(-ends // FAN)
    return levels


def _leaf_pairs(leaves: DataFrame, num: int, den: int) -> DataFrame:
    """(leaf_a, leaf_b) whose boxes may hold a linked pair, each pair once, found by descent from the root.

    A pair of boxes that may hold a link is followed to the pairs of their children; the others end there.
    """
    low_sum = F.col("n_lo_a") + F.col("n_lo_b")
    minima = F.aggregate(F.zip_with("hi_a", "hi_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    gap = F.aggregate(
        F.zip_with(F.zip_with("lo_a", "hi_b", lambda x, y: F.greatest(x - y, F.lit(0))),
                   F.zip_with("lo_b", "hi_a", lambda x, y: F.greatest(x - y, F.lit(0))),
                   lambda x, y: F.greatest(x, y)), F.lit(0), lambda s, x: s + x)
    levels = _tree(leaves)
    if not levels:
        return leaves.select(F.col("leaf").alias("leaf_a"), F.col("leaf").alias("leaf_b"))
    root = levels[-1]
    pairs = root.select(F.col("node").alias("node_a"), F.col("node").alias("node_b"))
    for level in reversed(levels[:-1]):
        below = level.withColumn("parent", F.floor(F.col("node") / FAN))
        a, b = (below.select(*(F.col(c).alias(f"{c}_{s}") for c in below.columns)) for s in "ab")
        above = pairs.select(F.col("node_a").alias("parent_a"), F.col("node_b").alias("parent_b"))
        pairs = (above.join(a, "parent_a").join(b, "parent_b").where("node_a <= node_b")
                 .where("region_lo_a <= region_hi_b and region_lo_b <= region_hi_a")
                 .where((F.col("n_lo_a") * num <= F.col("n_hi_b") * den) & (F.col("n_lo_b") * num <= F.col("n_hi_a") * den))
                 .where(minima * (den + num) >= low_sum * num)
                 .where(gap * (den + num) <= (F.col("n_hi_a") + F.col("n_hi_b")) * (den - num)))
    return pairs.select("leaf_a", "leaf_b")
