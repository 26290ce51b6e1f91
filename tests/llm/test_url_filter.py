import re

from pyspark.sql import functions as F

from acctrail.llm.queries import URL_RULES
from acctrail.llm.url_filter import FOLDS, _rate_columns, _rates, filter_urls, with_features, with_parts

SCHEMA = "page_id long, url string, html string, host string, label int"


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?y=1#z", "http://www.example.com/en/", "http://www.example.com/en",
        "https://b.example.com", "ftp://x.net/es/1", "ftp://x.net/fr/", "x://net/es/", "x://abnet/es/", "https://q.example.org/a/b.html?c=1&d=2",
        "a://b://c.com/", "http://É.Com/ÉN/", "http://h.net/de/\n/es/", "http://www.www.example.com/en/q"]


def rows():
    out = [(i, u, "h", "clash", 1) for i, u in enumerate(URLS)]
    out += [(100 + i, f"http://s{i % 7}.example.com/{'en/some-long-name-' if i % 2 else 'es/'}{i}", None, None, None)
            for i in range(300)]
    return out + [(None, "http://s.example.com/en/1", None, None, None)] * 2


def test_parts_and_rules(spark):
    data = rows()
    got = filter_urls(spark.createDataFrame(data, SCHEMA), URL_RULES).collect()
    assert len(got) == len(data)
    want = sorted(((d[0] is None, d[0] or 0, *parts(d[1]), rule_of(*parts(d[1]))) for d in data), key=str)
    assert sorted(((g.page_id is None, g.page_id or 0, g.host, g.path, rule_of(g.host, g.path)) for g in got), key=str) == want
    for g in got:
        rule, verdict = rule_of(g.host, g.path)
        assert g.rule == rule and g.verdict == (verdict or ("block" if g.block_score >= 0.5 else "allow"))


def test_trees_learn_the_rules(spark):
    got = filter_urls(spark.createDataFrame(rows(), SCHEMA), URL_RULES).where("rule is not null").collect()
    right = sum((g.block_score >= 0.5) == (g.verdict == "block") for g in got)
    assert right / len(got) > 0.9


def test_no_labels_and_empty(spark):
    got = filter_urls(spark.createDataFrame([(1, "x://y.org/z", None, None, None)], SCHEMA), URL_RULES).collect()
    assert [(g.rule, g.verdict) for g in got] == [(None, "allow")]
    assert filter_urls(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []


def test_parts_alone(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    assert [(r.host, r.path) for r in with_parts(df).collect()] == [parts(u) for u in URLS]


def test_one_repeated_url_does_not_fill_the_sample(spark):
    data = [(i, "http://a.net/es/x", None, None, None) for i in range(300)]
    data += [(1000 + i, f"http://h{i}.{'net/es/' if i % 2 else 'com/'}p{i}", None, None, None) for i in range(400)]
    got = filter_urls(spark.createDataFrame(data, SCHEMA), URL_RULES, sample_rows=200).collect()
    assert len(got) == 700 and sum((g.block_score >= 0.5) == (g.verdict == "block") for g in got) > 650


def test_held_out_hosts(spark):
    """Rules for some hosts say enough of the shape of bad URLs to judge hosts that no rule names."""
    rules = [("block", "net", "/es/"), ("allow", "net", "/"), ("allow", "com", "/")]
    data = []
    for i in range(900):
        host, bad = f"h{i % 90}.{['net', 'com', 'org'][i % 3]}", i % 2
        path = f"es/{i * 7919}{i}/{i}?a={i}&b=2&c=3" if bad and i % 3 != 1 else f"about-{'abcdefgh'[i % 8]}"
        data.append((i, f"http://{host}/{path}", None, None, None))
    got = filter_urls(spark.createDataFrame(data, SCHEMA), rules).where("rule is null").collect()
    urls = {d[0]: d[1] for d in data}
    right = sum((g.verdict == "block") == ("/es/" in urls[g.page_id]) for g in got)
    assert len(got) == 300 and right / len(got) > 0.95


def test_rates_leave_out_the_own_fold(spark):
    data = [(i, f"http://h{i % 20}.{'net/es/' if i % 2 else 'net/'}p{i}", None, None, None) for i in range(200)]
    data += [(500, "http://only.xyz/", None, None, None), (501, "http://a.org/q", None, None, None)]
    df = with_features(with_parts(spark.createDataFrame(data, SCHEMA).select("page_id", "url")))
    df = df.withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int"))
    df = df.withColumn("label", F.when(F.col("suffix") != "org", F.col("path").startswith("/es/").cast("double")))
    got = df.join(_rates(df.where("label is not null"), "suffix"), "suffix", "left").withColumns(_rate_columns("suffix")).collect()
    for r in got:
        rest = [x for x in got if x.label is not None and x.suffix == r.suffix and (r.label is None or x.fold != r.fold)]
        assert abs(r.suffix_rate - (sum(x.label for x in rest) + 1) / (len(rest) + 2)) < 1e-12
    assert {r.suffix_rate for r in got if r.suffix in ("xyz", "org")} == {0.5}
