"""Registered queries of the corpus operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import token_digests
from .common import fold, table
from .consistent_parse import document_fingerprints
from .decontaminate import find_passages
from .jaccard_join import jaccard_components
from .langid import identify_language, train_language_id
from .license_scan import oracle as license_oracle
from .license_scan import scan_licenses
from .merkle import merkle_manifest
from .pii import KINDS, count_kind, find_pii, spans_text, train_pii
from .substring_dedup import dedup_substrings
from .token_alignment import alignment_report
from .toxicity import toxic_spans, train_toxicity
from .url_filter import filter_urls
from .vector_dedup import dedup_vectors

QueryFn = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def rank_file() -> tuple[str, str]:
    """Place of the public rank file and its split pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_pii(docs, train_pii(docs))
    return found.select("doc_id", *(count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS),
                        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), *rank_file())


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 3, Fraction(90, 100))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    offsets = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return toxic_spans(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), F.array_join(offsets, ",").alias("offsets"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, train_language_id(docs, folds=4, held_out=2))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), 20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def aligned_files() -> tuple[str, str]:
    """Places of the public byte-level and sentence-piece tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampered rows: those whose id's crc32 is a multiple of 5; a null id is never tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    claims = {"text": F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))}
    return merkle_manifest(table(spark, sf_dir, "documents"), claims=claims).drop("proof")


MERKLE_SQL = f"""
WITH RECURSIVE given AS (
    SELECT *, row_number() OVER () AS rid, coalesce('s' || source, 'n') AS tree,
        coalesce(xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda a, e: xor(xor(a, e) >> 1, 3988292384::UBIGINT * (xor(a, e) & 1))), 4294967295::UBIGINT) % 5 = 0, false) AS hit
    FROM documents
), fields AS (
    SELECT rid, hit, text,
        concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
            coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
        CASE WHEN hit THEN translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END AS told
    FROM given
), hashed AS (
    SELECT g.doc_id, g.rid, g.tree, g.source, sha256(concat(head, coalesce(strlen(f.text) || ':' || f.text, '-'))) AS leaf,
        sha256(concat(head, coalesce(strlen(told) || ':' || told, '-'))) AS claimed
    FROM given g JOIN fields f USING (rid)
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed
), nodes(tree, source, level, pos, digest, n) AS (
    SELECT tree, source, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
    UNION ALL
    SELECT tree, any_value(source), level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16
), subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
), crown(level, pos, digest, n) AS (
    SELECT 0, pos, digest, count(*) OVER () FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM crown WHERE n > 1 GROUP BY level, pos // 16
), runs AS (
    SELECT tree, level, pos // 16 AS parent, string_agg(digest, '' ORDER BY pos) AS run FROM nodes WHERE n > 1 GROUP BY ALL
), crown_runs AS (
    SELECT level, pos // 16 AS parent, string_agg(digest, '' ORDER BY pos) AS run FROM crown WHERE n > 1 GROUP BY ALL
), steps AS (
    SELECT l.rid, r.level AS step, (l.pos >> (4 * r.level)) % 16 AS place, r.run
    FROM leaves l JOIN runs r ON r.tree = l.tree AND r.parent = l.pos >> (4 * r.level + 4)
    UNION ALL
    SELECT l.rid, 1000 + r.level, (s.pos >> (4 * r.level)) % 16, r.run
    FROM leaves l JOIN subroots s USING (tree) JOIN crown_runs r ON r.parent = s.pos >> (4 * r.level + 4)
), ways AS (
    SELECT rid, list(place || ':' || run ORDER BY step) AS way,
        string_agg(substr(run, 1, 64 * place) || substr(run, 64 * place + 65), '' ORDER BY step) AS proof
    FROM steps GROUP BY rid
), folded AS (
    SELECT l.*, s.digest AS subroot, (SELECT digest FROM crown WHERE n = 1) AS root, coalesce(proof, '') AS proof,
        list_reduce(list_prepend(claimed, coalesce(way, [])), lambda a, e: sha256(concat(
            substr(split_part(e, ':', 2), 1, 64 * split_part(e, ':', 1)::INTEGER), a,
            substr(split_part(e, ':', 2), 64 * split_part(e, ':', 1)::INTEGER + 65)))) AS folded_root
    FROM leaves l JOIN subroots s USING (tree) LEFT JOIN ways USING (rid)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""


#: words are runs of anything but space and 0x09-0x0D; joined by one space they stay apart
_WORDS_SQL = r"""
given AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
    SELECT rid, doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM given
)"""

#: Shingle sets, links between distinct sets (a link needs a common shingle among the rarest tenth and one
#: more of the smaller set, so candidates meet there; overlaps are then counted whole), reachability.
JACCARD_SQL = "WITH RECURSIVE" + _WORDS_SQL.format(
    text=f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')") + """, grams AS (
    SELECT DISTINCT rid, gram FROM (
        SELECT rid, n, pos, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS gram
        FROM words) WHERE pos <= n - 2 OR pos = 1
), sets AS (
    SELECT rid, md5(string_agg(gram, chr(10) ORDER BY gram)) AS cls, count(*) AS size FROM grams GROUP BY rid
), classes AS (
    SELECT cls, any_value(size) AS size, min(rid) AS rid FROM sets GROUP BY cls
), members AS (
    SELECT c.cls, c.size, gram, count(*) OVER (PARTITION BY gram) AS df FROM classes c JOIN grams USING (rid)
), rare AS (
    SELECT cls, size, gram FROM members
    QUALIFY row_number() OVER (PARTITION BY cls ORDER BY df, gram) <= size - (90 * size + 99) // 100 + 1
), candidates AS (
    SELECT DISTINCT a.cls AS a, b.cls AS b, a.size AS na, b.size AS nb FROM rare a JOIN rare b USING (gram)
    WHERE a.cls < b.cls AND 100 * least(a.size, b.size) >= 90 * greatest(a.size, b.size)
), links AS (
    SELECT a, b FROM candidates JOIN members x ON x.cls = a JOIN members y ON y.cls = b AND y.gram = x.gram
    GROUP BY a, b, na, nb HAVING 100 * count(*) >= 90 * (na + nb - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(cls, other) AS (
    SELECT cls, cls FROM classes
    UNION
    SELECT cls, b FROM reach JOIN both_ways ON a = other
), ids AS (
    SELECT cls, min(doc_id) AS least_id FROM sets JOIN given USING (rid) GROUP BY cls
), named AS (
    SELECT r.cls, min(least_id) AS component_id FROM reach r JOIN ids ON ids.cls = other GROUP BY r.cls
)
SELECT doc_id, coalesce(size, 0) AS n_shingles, CASE WHEN size IS NULL THEN doc_id ELSE component_id END AS component_id
FROM given LEFT JOIN sets USING (rid) LEFT JOIN named USING (cls)
"""

#: For tables whose texts under one doc_id are equal (the operator orders others by a checksum).
SUBSTRING_SQL = "WITH" + _WORDS_SQL.format(text="coalesce(text, '')") + """, windows AS (
    SELECT *, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win
    FROM words
), judged AS (
    SELECT rid, pos, word, pos <= n - 19 AND rank() OVER (PARTITION BY win, pos <= n - 19 ORDER BY doc_id NULLS LAST, pos) > 1 AS again
    FROM windows
), covered AS (
    SELECT rid, pos, word, bool_or(again) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM judged
), kept AS (
    SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept_text
    FROM covered GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM given LEFT JOIN kept USING (rid)
"""


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"), *aligned_files())


def registry() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_url_filter, op2_pii, op3_byte_bpe, op4_license_scan, op5_embedding_dedup, op6_ngram_jaccard, op7_toxicity,
        op8_language_id, op9_decontamination, op10_substring_dedup, op11_fingerprints,
        op12_merkle_manifest,
        op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": license_oracle(), "op6_ngram_jaccard": JACCARD_SQL,
            "op10_substring_dedup": SUBSTRING_SQL, "op12_merkle_manifest": MERKLE_SQL}
