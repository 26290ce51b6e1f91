import hashlib
import random

from pyspark.sql import functions as F

import corpus_pipeline
from acctrail.llm.decontaminate import best_run
from acctrail.llm.queries import rank_file
from tests.llm.test_jaccard_join import shingles

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def make(tmp_path, spark):
    rnd = random.Random(12)
    vocab = [a + b + c for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    item = " ".join(rnd.choices(vocab, k=30))
    docs, labels = [], []
    for i in range(260):
        words = rnd.choices(vocab, k=rnd.randint(12, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["vile", "rotten", "scumbag"]))
        if i % 13 == 1:
            words[5:5] = item.split()[:14] + ["changed"] + item.split()[15:]
        if i % 11 == 2:
            words.append(f"u{i}@mail.example.com")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, t + " tail") for i, t in docs[:60]] + [(2000 + i, t) for i, t in docs[:20]]
    docs += [(3001, None), (3002, ""), (3003, "one")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs, item


def test_stages_match_brute_force(spark, tmp_path):
    docs, item = make(tmp_path, spark)
    given = docs = dict(docs)
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        if name != "token_ids":
            assert out.dtypes == df.dtypes
            rows = out.collect()
            kept = {r.doc_id: r.text for r in rows}
            assert len(kept) == len(rows)
        if name == "toxicity":
            assert kept == {i: t for i, t in docs.items() if not {"vile", "rotten", "scumbag"} & set((t or "").split())}
        elif name == "near_duplicates":
            want, seen = {}, []
            for i, t in sorted(docs.items()):
                s = shingles(t, 5)
                if not any(s and 10 * len(s & o) >= 8 * len(s | o) for o in seen):
                    want[i] = t
                seen.append(s)
            assert kept == want
        elif name == "decontamination":
            assert kept == {i: t for i, t in docs.items() if best_run(item.split(), (t or "").split())[0] > 6}
        elif name == "personal_data":
            assert set(kept) == set(docs)
            assert all((r.text is None and given[r.doc_id] is None) or "@" not in r.text for r in rows)
            assert all(r.text == docs[r.doc_id] for r in rows if "@" not in (docs[r.doc_id] or ""))
            assert all(r.n_chars == len(r.text or "") for r in rows)
        else:
            got = {r.doc_id: r for r in out.collect()}
            assert set(got) == set(docs)
            for i, r in got.items():
                assert r.decoded_sha256 == hashlib.sha256((docs[i] or "").encode()).hexdigest()
                assert len(r.ids) == 4 * r.n_tokens and rank_file()
            break
        docs, df = kept, spark.createDataFrame(rows, df.schema)


def test_run_on_an_empty_table(spark, tmp_path):
    for name, schema in (("documents", COLUMNS), ("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_clashing_columns(spark, tmp_path):
    make(tmp_path, spark)
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    odd = ["_masked", "_jaccard_doc", "_jaccard_text", "__jaccard_text", "score", "spans", "label", "_MASKED2"]
    given = df.drop("n_chars")
    for i, c in enumerate(odd):
        given = given.withColumn(c, F.concat(F.lit(f"{i}-"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, str(tmp_path))
        assert out.dtypes == given.dtypes
        rows = out.collect()
        assert rows and all(r[c] == f"{i}-{r.doc_id}" for r in rows for i, c in enumerate(odd)), name
