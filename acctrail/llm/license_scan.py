"""License notices: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

DataFrame functions only. Words are lower-cased runs of letters and digits,
shingles are 64-bit hashes of ``K`` consecutive words. A template of L shingles
belongs to the size class s, the power of two with s/2 < L <= s; its windows
hold 2s shingles and start at every multiple of s, so every run of L shingles lies whole
in a window. Such a window has Jaccard similarity above 0.18 with a template
of which it contains 0.8, so ``BANDS`` one-row bands miss it with probability
below 0.82 ** BANDS (7e-5 at 48).

A band can only collide in a window that holds a template shingle, so
texts without any are dropped first and only windows around such shingles are
hashed; this changes no result. Texts are not shuffled.

A template under ``K`` words has its whole sequence as one shingle and is
held against the runs of as many words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, text_of

K, BANDS, BLOCK_SHINGLES = 5, 48, 2000

#: Public license notices.
LICENSES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
]


def _shingles(text: Column, k: int) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")

    def hashes(w):
        return F.when(F.size(w) >= k, F.transform(
            F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k)))))

    # one evaluation of the split: bound as the variable of a one-element transform
    return F.coalesce(F.get(F.transform(F.array(words), hashes), F.lit(0)), F.array().cast("array<bigint>"))


def _signature(shingles: Column, bands: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(bands)),
                       lambda b: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, b))))


def _templates(spark: SparkSession, licenses: list[tuple[str, str]], k: int) -> list[tuple[int, list]]:
    """(shingle length, rows (license, shingles, class size)) in blocks of at most BLOCK_SHINGLES shingles.

    The length is ``k``, or that of the templates where they have fewer words.
    """
    df = spark.createDataFrame(licenses, "license string, text string")
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " ")), " ")
    wide = df.select("license", "text", F.least(F.size(F.filter(words, lambda x: x != "")), F.lit(k)).alias("k"))
    out = []
    for length in sorted((r.k for r in wide.select("k").where("k > 0").distinct().collect()), reverse=True):
        rows = wide.where(F.col("k") == length).select(
            "license", F.array_distinct(_shingles(F.col("text"), length)).alias("shingles")).collect()
        out += [(length, b) for b in _blocks(rows)]
    return out


def _blocks(rows: list) -> list[list]:
    blocks, size = [[]], 0
    for r in rows:
        if size and size + len(r.shingles) > BLOCK_SHINGLES:
            blocks.append([])
            size = 0
        blocks[-1].append((r.license, r.shingles, 1 << (len(r.shingles) - 1).bit_length()))
        size += len(r.shingles)
    return [b for b in blocks if b]


def scan_licenses(docs: DataFrame, licenses: list[tuple[str, str]] = LICENSES, k: int = K, containment: float = 0.8,
                  bands: int = BANDS) -> DataFrame:
    """doc_id, license, containment, windows: notices of which some window holds at least ``containment``.

    One row per license and distinct (doc_id, text) of ``docs``; containment is the largest
    share of the template's distinct shingles in one window, windows counts
    the windows that reach the threshold. Templates with fewer than ``k`` words have
    one shingle of their own length; those without words are never found.
    Null, empty and short texts give no row; a null doc_id stays null; other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    found = None
    for length, block in _templates(spark, licenses, k):
        templates = stored(spark.createDataFrame(block, "license string, template array<long>, class int"), "licenses")
        keys = sorted({x for _, s, _ in block for x in s})
        sizes = sorted({c for *_, c in block})
        cut = base.select("doc_id", F.xxhash64("text").alias("text_id"), _shingles(F.col("text"), length).alias("shingles"))
        part = _scan_block(cut, templates, keys, sizes, containment, bands)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, license string, containment double, windows long")
    return (found.groupBy("doc_id", "text_id", "license")
            .agg(F.max("containment").alias("containment"), F.count(F.lit(1)).alias("windows"))
            .select("doc_id", "license", "containment", "windows"))


def _scan_block(base: DataFrame, templates: DataFrame, keys: list[int], sizes: list[int], containment: float, bands: int):
    known = F.array(*(F.lit(x) for x in keys)).cast("array<bigint>")
    hits = (base.withColumn("met", F.array_intersect("shingles", known)).where(F.size("met") > 0)
            .withColumn("at", F.explode(F.filter(F.sequence(F.lit(0), F.size("shingles") - 1),
                                                 lambda i: F.array_contains("met", F.get("shingles", i))))))
    spots = hits.withColumn("class", F.explode(F.array(*(F.lit(s) for s in sizes))))
    spots = spots.withColumn("slot", F.floor(F.col("at") / F.col("class")))
    spots = spots.withColumn("slot", F.explode(F.array(F.col("slot"), F.col("slot") - 1))).where("slot >= 0")
    windows = (spots.select("doc_id", "text_id", "class", "slot",
                            F.slice("shingles", (F.col("slot") * F.col("class") + 1).cast("int"), F.col("class") * 2).alias("window"))
               .dropDuplicates(["doc_id", "text_id", "class", "slot"]))
    banded = windows.select("*", F.posexplode(_signature(F.col("window"), bands)).alias("band", "low"))
    wanted = templates.select("class", "license", "template",
                              F.posexplode(_signature(F.col("template"), bands)).alias("band", "low"))
    share = F.size(F.array_intersect("window", "template")) / F.size("template")
    # at most BLOCK_SHINGLES templates in a block
    return (banded.join(F.broadcast(wanted), ["class", "band", "low"])
            .select("doc_id", "text_id", "license", "slot", share.alias("containment"))
            .where(F.col("containment") >= containment)
            .dropDuplicates(["doc_id", "text_id", "license", "slot"]))


def oracle(licenses: list[tuple[str, str]] = LICENSES, k: int = K, containment: float = 0.8) -> str:
    """The same rows in DuckDB SQL: every window of every text against every template, without hashing."""
    names = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in licenses)
    return f"""
WITH given(license, text) AS (VALUES {names}),
t AS (SELECT license, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM given),
shingle AS (SELECT DISTINCT license, array_to_string(w[i:i + {k - 1}], ' ') AS s
            FROM (SELECT license, w, unnest(range(1, len(w) - {k - 2})) AS i FROM t)),
size AS (SELECT license, count(*) AS n, power(2, ceil(log2(count(*))))::BIGINT AS class FROM shingle GROUP BY license),
d AS (SELECT DISTINCT doc_id, md5(coalesce(text, '')) AS text_id,
             string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM documents),
p AS (SELECT doc_id, text_id, i - 1 AS spot, array_to_string(w[i:i + {k - 1}], ' ') AS s
      FROM (SELECT doc_id, text_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM d)),
hit AS (SELECT p.doc_id, p.text_id, license, s, unnest([spot // class, spot // class - 1]) AS slot, n
        FROM p JOIN shingle USING (s) JOIN size USING (license)),
win AS (SELECT doc_id, text_id, license, slot, count(DISTINCT s) / any_value(n)::DOUBLE AS c
        FROM hit WHERE slot >= 0 GROUP BY doc_id, text_id, license, slot)
SELECT doc_id, license, max(c) AS containment, count(*) AS windows
FROM win WHERE c >= {containment} GROUP BY doc_id, text_id, license"""
