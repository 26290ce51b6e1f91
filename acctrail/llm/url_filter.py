"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones. From them come the block
rate of every host suffix and file suffix (counted over all of them) and, on
a bounded sample, the trees. A labelled URL's rates leave out its own fold
of hosts, so the trees learn how far rates of other hosts are to be trusted.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = ["url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "host_digit_ratio", "hyphens",
            "entropy", "params", "has_query", "has_fragment", "longest_label", "suffix_rate", "suffix_log_n",
            "file_rate", "file_log_n"]
FOLDS = 5


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for null or without '://'."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return (df.withColumn("host", F.translate(F.regexp_extract(text, _PARTS, 1), UPPER, LOWER))
            .withColumn("path", F.regexp_extract(text, _PARTS, 2)))


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits host and path; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    chars = F.array_distinct(F.split(text, ""))

    def add(total, c):
        count = (n - F.length(F.replace(text, c, F.lit("")))).cast("double")
        return total + F.when(count > 0, count * F.log2(count)).otherwise(0.0)

    return F.when(n > 0, F.log2(n.cast("double")) - F.aggregate(chars, F.lit(0.0), add) / n).otherwise(0.0)


def _ratio(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1))


def with_features(df: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    names = F.split(host, r"\.")
    return (df.withColumn("suffix", F.element_at(names, -1))
            .withColumn("file", F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1))
            .withColumns({
                "url_len": F.length(url), "host_len": F.length(host), "path_len": F.length(path),
                "depth": F.size(F.split(path, "/")) - 1, "labels": F.size(names),
                "digit_ratio": _ratio(url), "host_digit_ratio": _ratio(host),
                "hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))),
                "entropy": _entropy(host), "has_query": url.contains("?").cast("int"),
                "params": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0),
                "has_fragment": url.contains("#").cast("int"),
                "longest_label": F.array_max(F.transform(names, lambda x: F.length(x)))}))


def _rates(labelled: DataFrame, column: str) -> DataFrame:
    """Per value of ``column``: labelled URLs and blocked ones of each fold of hosts, as arrays."""
    each = [(F.count(F.when(F.col("fold") == f, 1)), F.count(F.when((F.col("fold") == f) & (F.col("label") == 1), 1)))
            for f in range(FOLDS)]
    return labelled.groupBy(column).agg(F.array(*(n for n, _ in each)).alias("urls"), F.array(*(b for _, b in each)).alias("blocked"))


def _rate_columns(prefix: str) -> dict[str, Column]:
    """Smoothed block rate and support from the folds other than a labelled URL's own; all of them for other URLs."""
    def total(counts):
        everything = F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)
        return F.coalesce(everything - F.when(F.col("label").isNotNull(), F.get(F.col(counts), F.col("fold"))).otherwise(0), F.lit(0))

    return {f"{prefix}_rate": (total("blocked") + 1) / (total("urls") + 2), f"{prefix}_log_n": F.log1p(total("urls"))}


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], sample_rows: int = 20_000, trees: int = 20,
                depth: int = 4, block_at: float = 0.5, seed: int = 7) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, block_score.

    verdict is the rule's, else "block" when the trees' block probability is at
    least ``block_at``, else "allow". The trees learn from the ``sample_rows``
    distinct URLs with the smallest hash among those that a rule decides. If these
    show fewer than two verdicts, there is nothing to learn and the score is 0
    ("allow"). A null URL or one without "://" has an empty host and path and is
    judged on those. Null page_ids and repeated rows stay; other columns are
    not read. Runs jobs.
    """
    rule, verdict = rule_columns(rules)
    urls = with_parts(pages.select("page_id", F.col("url").cast("string").alias("url")))
    urls = with_features(urls.withColumn("rule", rule).withColumn("by_rule", verdict))
    urls = urls.withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int"))
    urls = urls.withColumn("label", F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("double")))
    labelled = urls.where("label is not null")
    for column in ("suffix", "file"):
        rates = stored(_rates(labelled, column), f"url-{column}")
        urls = urls.join(rates, column, "left").withColumns(_rate_columns(column)).drop("urls", "blocked")
    urls = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(urls)
    sample = hash_sample(urls.where("label is not null").select("url", "features", "label"), "url", sample_rows,
                         "url-sample").select("features", "label")
    if sample.select("label").distinct().count() < 2:
        scored = urls.withColumn("block_score", F.lit(0.0))
    else:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=64).fit(sample)
        scored = model.transform(urls).withColumn("block_score", vector_to_array("probability")[1])
    by_method = F.when(F.col("block_score") >= block_at, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "block_score")
