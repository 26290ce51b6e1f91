import math
import random
import re

from pyspark.sql import functions as F

from acctrail.llm.license_scan import LICENSES, scan_licenses

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).strip().split(" ")
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(rows):
    out = []
    for d, text in {(d, t or "") for d, t in rows}:
        s = shingles(text)
        for name, notice in LICENSES:
            t = set(shingles(notice))
            c = 1 << math.ceil(math.log2(len(t)))
            shares = [len(t & set(s[a:a + 2 * c])) / len(t) for a in range(0, len(s), c)]
            good = [x for x in shares if x >= 0.8]
            if good:
                out.append((d, name, max(good), len(good)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("class", F.lit(1)).withColumn("license", F.lit("x"))
    got = [tuple(r) for r in scan_licenses(df.repartition(3)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_planted_notices(spark):
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(50)] + ["under", "the", "license", "licensed"]
    rows = []
    for d in range(120):
        words = rnd.choices(vocab, k=rnd.randint(0, 150))
        for _ in range(rnd.randint(0, 2)):
            notice = rnd.choice(LICENSES)[1].split()
            if rnd.random() < 0.4:
                notice[rnd.randrange(len(notice))] = "changed"
            at = rnd.randint(0, len(words))
            words[at:at] = notice
        rows.append((d, " ".join(words)))
    check(spark, rows)


def test_edges(spark):
    mit = "RELEASED under\nthe *MIT* license"
    check(spark, [(1, None), (2, ""), (3, "the MIT"), (4, mit), (4, mit), (5, mit + " " + mit), (None, mit), (6, "x " * 5000 + mit)])


def test_templates_under_five_words(spark):
    short = [("spdx", "SPDX-License-Identifier: MIT"), ("two", "All rights."), ("one", "WTFPL"), ("none", "--"), LICENSES[0]]
    rows = [(1, "# spdx license identifier (MIT)"), (2, "SPDX-License-Identifier: Apache all right"), (3, "see WTFPL, wtfpl"),
            (4, LICENSES[0][1] + " All rights reserved."), (5, None), (6, "wtfpl2"), (None, "all RIGHTS")]
    got = [tuple(r) for r in scan_licenses(spark.createDataFrame(rows, SCHEMA), short).collect()]
    assert sorted((r[:3] for r in got), key=key) == sorted(
        [(1, "spdx", 1.0), (3, "one", 1.0), (4, "MIT", 1.0), (4, "two", 1.0), (None, "two", 1.0)], key=key)


def test_plan_is_native(spark):
    plan = scan_licenses(spark.createDataFrame([(1, "a")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty(spark):
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []
    assert scan_licenses(spark.createDataFrame([(1, "a b c d e f")], SCHEMA), [("short", "two words")]).collect() == []
