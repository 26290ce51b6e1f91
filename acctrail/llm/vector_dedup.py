"""Near-duplicate vectors by sorted projection passes.

Equal (label, vector) rows form one class. Each pass gives a class a key of
``KEY_BITS`` random-hyperplane signs and sorts the classes of a label by it. Two classes are
compared in a pass when they lie within ``window`` places of each other, or in
the same run of equal ``b``-bit key prefixes; b follows the number of classes so that
a run of unrelated vectors stays short, and the number of passes follows from b
so that a pair at the threshold shares a run in some pass with probability
``recall``. Runs have no size cap: a long one is cut into blocks, and each
pair of blocks is a task of its own.

Which passes compare a pair can be read off its places and keys, so a link is
counted in the first of them only, and tasks emit counts and a spanning set of links
instead of pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .graph import components

KEY_BITS = 30
BLOCK = 512


def plan_passes(classes: int, cosine: float, recall: float) -> tuple[int, int]:
    """(prefix bits, passes) for a number of classes."""
    bits = min(KEY_BITS, max(4, math.ceil(math.log2(max(classes, 1) / 64 + 1))))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def _keyed(passes: int, seed: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(KEY_BITS)[::-1].astype(np.int64)
        for pdf in batches:
            out = []
            for dim, part in pdf.groupby("dim"):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).normal(size=(dim, passes * KEY_BITS))
                x = np.stack([np.asarray(v, np.float64) for v in part["vec"]])
                # scaled to unit length first, so that neither sums nor products overflow
                x = x / np.abs(x).max(1, keepdims=True)
                signs = (x @ planes[dim] > 0).reshape(len(x), passes, KEY_BITS)
                key = (signs * powers).sum(2)
                out.append(pd.DataFrame({"pass": np.tile(np.arange(passes, dtype=np.int32), len(x)),
                                         "label": np.repeat(part["label"].to_numpy(), passes),
                                         "dim": np.int32(dim), "key": key.ravel(),
                                         "uid": np.repeat(part["uid"].to_numpy(), passes)}))
            if out:
                yield pd.concat(out)
    return run


def _compare(cosine: float, window: int):
    def run(key, pdf):
        p, b1, b2 = key
        left = pdf[pdf["block"] == b1]
        right = left if b1 == b2 else pdf[pdf["block"] == b2]
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": pd.array([], "Int64"), "links": np.zeros(0, np.int64)})
        if not len(left) or not len(right):
            return none
        rows = []
        for dim in sorted(set(left["dim"]) & set(right["dim"])):
            l, r = left[left["dim"] == dim], right[right["dim"] == dim]

            def unit(d):
                x = np.stack([np.asarray(v, np.float64) for v in d["vec"]])
                x = x / np.abs(x).max(1, keepdims=True)
                return x / np.sqrt((x * x).sum(1, keepdims=True))

            i, j = np.nonzero(unit(l) @ unit(r).T >= cosine)
            same = l["label"].to_numpy()[i] == r["label"].to_numpy()[j]
            same &= (i < j) if b1 == b2 else True
            i, j = i[same], j[same]
            if not len(i):
                continue
            place_l, place_r = (np.stack(d["places"].to_numpy())[:, : p + 1] for d in (l, r))
            run_l, run_r = (np.stack(d["runs"].to_numpy())[:, : p + 1] for d in (l, r))
            met = (np.abs(place_l[i] - place_r[j]) <= window) | (run_l[i] == run_r[j])
            now = met[:, p]
            first = now & ~met[:, :p].any(1)
            ul, ur = l["uid"].to_numpy(), r["uid"].to_numpy()
            ml, mr = l["copies"].to_numpy(), r["copies"].to_numpy()
            for uid, at, n in ((ul, i, mr[j]), (ur, j, ml[i])):
                count = np.bincount(at[first], n[first], len(uid)).astype(np.int64)
                rows.append(pd.DataFrame({"a": uid, "b": pd.array([None] * len(uid), "Int64"), "links": count})[count > 0])
            # a spanning set of this block pair's links
            label = {}
            for x, y in zip(ul[i[first]].tolist(), ur[j[first]].tolist(), strict=True):
                rx, ry = x, y
                while label.get(rx, rx) != rx:
                    rx = label[rx]
                while label.get(ry, ry) != ry:
                    ry = label[ry]
                label[x], label[y] = rx, ry
                if rx != ry:
                    label[max(rx, ry)] = min(rx, ry)
                    rows.append(pd.DataFrame({"a": [x], "b": pd.array([y], "Int64"), "links": [0]}))
        return pd.concat(rows) if rows else none
    return run


def dedup_vectors(vectors: DataFrame, cosine: float = 0.98, window: int = 32, recall: float = 0.995, seed: int = 3) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and not null and the cosine of their
    embeddings (double precision) is at least ``cosine``; n_links counts the rows linked directly, component_id is
    the smallest vec_id reachable by links, kept is vec_id = component_id. No
    link is below the threshold; a pair of different vectors at the threshold is found with
    probability ``recall`` at least, equal vectors always.

    Embeddings that are null, empty, zero, or hold a null or non-finite component, and rows
    with a null label, link with nothing (n_links 0, own component). Vectors of different
    length never link. Repeated rows count as rows of their own. A null vec_id takes part but names a component only if
    all ids are null; kept is then null. Other columns are not read. Runs jobs.
    """
    # single-precision vectors travel as they are and widen where they are compared, which is exact
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<float>" if single else "array<double>").alias("vec"))
    sound = (F.col("label").isNotNull() & (F.size("vec") > 0) & F.coalesce(
        ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vec", lambda x: x != 0), F.lit(False)))
    base = base.withColumn("sound", F.coalesce(sound, F.lit(False)))
    group = ["label", "vec"]
    classes = stored(base.where("sound").groupBy(*group).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("uid", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "vectors")
    bits, passes = plan_passes(classes.count(), cosine, recall)

    order = ["pass", "label", "dim", "key", "uid"]
    sorted_keys = (classes.select("uid", "label", "dim", "vec")
                   .mapInPandas(_keyed(passes, seed), "pass int, label long, dim int, key long, uid long")
                   .repartitionByRange(*order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id()  # partition number above 33 bits of row number
    sorted_keys = stored(sorted_keys.withColumn("at", at), "vector-keys")
    part = F.shiftright("at", 33)
    sizes = sorted_keys.groupBy(part.alias("part")).agg((F.max(F.col("at").bitwiseAND((1 << 33) - 1)) + 1).alias("size"))
    # one row per partition
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    run_id = F.shiftright("key", KEY_BITS - bits)
    placed = (sorted_keys.withColumn("part", part).join(F.broadcast(before), "part")
              .select("pass", "label", "dim", "uid", run_id.alias("run"),
                      (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place")))
    placed = stored(placed.withColumn("block", F.floor(F.col("place") / BLOCK)), "vector-places")
    runs = placed.groupBy("pass", "label", "dim", "run").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    reach = placed.join(runs, ["pass", "label", "dim", "run"]).select(
        "pass", "uid", "block",
        F.least("first", F.floor(F.greatest(F.col("place") - window, F.lit(0)) / BLOCK)).alias("first"),
        F.greatest("last", F.floor((F.col("place") + window) / BLOCK)).alias("last"))
    # one place and run per pass, in pass order
    history = placed.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("pass", "place", "run"))).alias("h"))
    full = classes.join(history, "uid").select("uid", "label", "dim", "vec", "copies", F.col("h.place").alias("places"), F.col("h.run").alias("runs"))
    tasks = (reach.join(full, "uid").withColumn("other", F.explode(F.sequence("first", "last")))
             .withColumn("b1", F.least("block", "other")).withColumn("b2", F.greatest("block", "other")))
    found = stored(tasks.select("pass", "b1", "b2", "block", "uid", "label", "dim", "vec", "copies", "places", "runs")
                   .groupBy("pass", "b1", "b2").applyInPandas(_compare(cosine, window), "a long, b long, links long"), "vector-links")
    linked = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    rooted = (classes.select("uid", *group, "rep", "copies").join(linked.withColumnRenamed("node", "uid"), "uid", "left")
              .withColumn("root", F.coalesce("root", "uid")))
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = (rooted.join(named, "root").join(counts, "uid", "left")
             .select(*group, "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = (base.where("sound").join(named, group).select("vec_id", "n_links", "component_id")
           .unionByName(base.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
