import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from acctrail.llm import queries
from acctrail.llm.merkle import height, merkle_manifest, sweep_down, sweep_up

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests, fanout):
    out = [digests]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h("".join(last[i:i + fanout])) for i in range(0, len(last), fanout)])
    return out


def path(tree, i, fanout):
    out = []
    for level in tree[:-1]:
        at = i // fanout * fanout
        out.append((i - at, level[at:at + fanout]))
        i //= fanout
    return out


def brute(rows, claimed, fanout=16):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]], fanout)
    crown = levels([trees[s][-1][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            way = path(trees[s], i, fanout) + path(crown, k, fanout)
            d = leaf(claimed(r))
            for place, run in way:
                d = h("".join(d if j == place else x for j, x in enumerate(run)))
            proof = "".join(x for place, run in way for j, x in enumerate(run) if j != place)
            out.append((r[0], leaf(r), trees[s][-1][0], crown[-1][0], h(proof), d, d == crown[-1][0]))
    return sorted(out, key=str)


def lowered(r):
    if r[0] is None or r[4] is None or zlib.crc32(str(r[0]).encode()) % 5:
        return r
    return (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                               "verified").collect()), key=str)


def sample(sizes, seed=1):
    rnd = random.Random(seed)
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i, source, rnd.choice(["en", None]), rnd.choice([3, None]),
                         rnd.choice([None, "", f"Größe {i}", f"lower {i}", f"Upper É {i}"])))
    rnd.shuffle(rows)
    return rows


def test_block_sweeps_agree_with_levels():
    for n in (1, 2, 3, 4, 5, 16, 17, 40):
        leaves = [h(str(i)) for i in range(n)]
        for fanout in (2, 3, 16):
            tree = sweep_up(leaves, height(n, fanout), fanout)
            assert tree == levels(leaves, fanout)
            want = [";".join(f"{p}:{''.join(run)}" for p, run in path(tree, i, fanout)) for i in range(n)]
            assert sweep_down(tree, "", fanout) == want


def query(spark, rows, **options):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, queries.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle_manifest(spark.createDataFrame(rows, SCHEMA), claims={"text": text}, **options)


def test_brute_force_with_nulls_repeats_and_sizes(spark):
    rows = sample({"b": 1, "a": 16, "Z": 17, "é": 300, None: 35, "": 2})
    rows += [rows[0], rows[0], (None, "a", "en", 1, "UP"), (None, "a", None, None, None), (7, "a", "x", 1, "Same ID"), (7, "a", "y", 1, "t")]
    assert got(query(spark, rows)) == brute(rows, lowered)


@pytest.mark.parametrize("fanout,block_levels", [(2, 1), (2, 3), (3, 2)])
def test_many_rounds_of_blocks(spark, fanout, block_levels):
    rows = sample({f"s{i}": n for i, n in enumerate([1, 2, 3, 60, 9, 27, 28, 1, 5])}, 2)
    assert got(query(spark, rows, fanout=fanout, block_levels=block_levels)) == brute(rows, lowered, fanout)


def test_one_row_and_no_row(spark):
    rows = [(5, None, None, None, None)]
    assert got(query(spark, rows)) == brute(rows, lowered)
    assert got(query(spark, [])) == []


def test_tampering_is_seen_and_proof_digest_covers_the_proof(spark):
    df = query(spark, sample({"a": 40, "b": 3}, 3)).toPandas()
    assert 0 < (~df.verified).sum() < len(df)
    assert [h(p) for p in df.proof] == list(df.proof_sha256)


def test_extra_columns_with_the_operators_own_names(spark):
    rows = sample({"a": 20}, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("has", "grp", "key", "digest", "claimed", "pos", "size", "block", "path", "part", "salt", "leaf", "root"):
        df = df.withColumn(name, F.lit("x"))
    assert [r.leaf for r in merkle_manifest(df).orderBy("doc_id").collect()] == [leaf(r) for r in sorted(rows)]


def test_leaves_spread_when_one_group_holds_nearly_all(spark):
    from acctrail.llm.merkle import _numbered
    df = spark.range(4000).select(F.lit(True).alias("has"), F.when(F.col("id") < 3900, "hot").otherwise("cold").alias("grp"),
                                  F.lit(1).alias("key"), F.lit("same").alias("digest"))
    rows = _numbered(df, ["key", "digest"], "spread-test")
    assert sorted(r.pos for r in rows.where("grp = 'hot'").collect()) == list(range(3900))


def test_sql_of_the_query(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()['op12_merkle_manifest']})").fetchall()
    assert got(queries.op12_merkle_manifest(spark, sf)) == sorted(want, key=str)
