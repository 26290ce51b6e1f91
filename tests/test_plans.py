"""Plan shape assertions and the oracle comparison of every registered query (sf0.001)."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from acctrail.plans.catalog import registry
from oracle.sql import queries as oracle_queries
from acctrail.sources.tables import TABLES, table_path
from tools.check_oracle import ORDERED, digest

SF = "/root/testdata/sf0.001"
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark):
    for name, fn in registry().items():
        text = plan(fn(spark, SF))  # some write their inputs to the checkpoint folder first
        assert not any(n in text for n in PY_NODES), name


def test_history_windows_are_blocked(spark):
    text = registry()["product_history_counts"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", text)
    assert windows, text
    seen = set()
    for part in windows:
        keys = tuple(k.split("#")[0] for k in part.split(", "))
        # raw rows: (person, day, range); person alone only over the per-day histogram
        assert keys in (("person", "created", "_part"), ("person",)), keys
        seen.add(keys)
    assert seen == {("person", "created", "_part"), ("person",)}
    assert "HashAggregate" in text


def test_topk_uses_group_limit(spark):
    text = registry()["topk_rank_per_key"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in text


def test_first_touch_is_an_aggregate(spark):
    text = registry()["first_touch_join"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in text and "Aggregate" in text


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 96
    assert "previous_product" in df.columns and "line_id" in df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_matches_oracle(spark, duck, name):
    sdf = registry()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(oracle_queries()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows, name in ORDERED)[0] == digest(ocols, orows, name in ORDERED)[0]


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_queries())


def test_feature_tables_have_unique_keys(spark):
    """Reduced feature tables hold one row per key, so the mart's lookups never fan out."""
    from pyspark.sql import functions as F
    qs = registry()
    for name, keys in [("feature_deposit", ["line_id"]), ("feature_transfers", ["line_id"]),
                       ("feature_snapshot", ["line_id"]), ("feature_prior_accounts", ["line_id"]),
                       ("feature_payment_history", ["line_id"]), ("feature_autopay", ["line_id"]),
                       ("feature_trade_lines", ["decision_id", "line_id"])]:
        df = qs[name](spark, SF)
        assert df.groupBy(*keys).count().filter(F.col("count") > 1).count() == 0, name


def test_mart_has_one_row_per_repeat_purchase(spark):
    qs = registry()
    assert qs["mart_repeat_purchase"](spark, SF).count() == qs["repeat_purchase"](spark, SF).count()
    assert qs["mart_front_end"](spark, SF).count() == qs["scan_accounts"](spark, SF).count()


def test_the_ordered_comparison_sees_a_missing_sort(spark, duck):
    res = duck.execute(oracle_queries()["sort_history"])
    cols, rows = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in registry()["sort_history"](spark, SF).select(cols).collect()]
    assert digest(cols, got, True)[0] == digest(cols, rows, True)[0]
    unsorted = [tuple(r) for r in registry()["account_history"](spark, SF).select(cols).collect()]
    assert digest(cols, unsorted)[0] == digest(cols, rows)[0]
    assert digest(cols, unsorted, True)[0] != digest(cols, rows, True)[0]


def test_features_of_some_lines_equal_the_features_of_all(spark):
    """``only`` reduces the inputs, never the results of the lines it names."""
    from acctrail.plans.pipeline import Pipeline
    from acctrail.sources.roles import Roles
    p = Pipeline(Roles(spark, SF), as_of="2000-01-01", materialize=True)
    only = p.r.lines.select("line_id").filter("line_id % 5 = 1")
    for name in ("deposit", "transfers", "snapshot", "prior_accounts", "payment_history", "trade_lines", "autopay", "front_end"):
        build = getattr(p, name)
        some = build(only)
        want = build().join(only, "line_id", "left_semi").select(some.columns)
        assert sorted(map(str, some.collect())) == sorted(map(str, want.collect())), name


def test_final_mart_reduces_every_input_to_the_repeat_ids(spark):
    """In the plan a semi-join with the repeat ids stands between each large scan and the first aggregate above it."""
    text = registry()["mart_repeat_purchase"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    stack = []
    scans = reduced = 0
    for line in text.splitlines():
        depth = len(re.match(r"[ :+|-]*", line).group())
        stack = [s for s in stack if s[0] < depth] + [(depth, line)]
        if "Relation [" in line and "l_orderkey" in line:
            scans += 1
            above = [x for _, x in stack[:-1]]
            first_agg = max((i for i, x in enumerate(above) if "Aggregate" in x), default=-1)
            reduced += any("LeftSemi" in x for x in above[first_agg + 1:]) or any("LeftSemi" in x for x in above)
    assert scans and reduced == scans, text


def test_accounts_are_not_joined_back_to_themselves(spark):
    """One scan of the written accounts feeds the classification, and both forms of it agree."""
    from acctrail.plans.channels import ACCOUNT_COLUMNS, channel_classify
    from acctrail.plans.pipeline import Pipeline
    from acctrail.sources.roles import Roles
    p = Pipeline(Roles(spark, SF), as_of="2000-01-01", materialize=True)
    carried = p._classify(p.history(ACCOUNT_COLUMNS))
    for df in (carried, p.channels()):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Relation [" in line and "lap_id#" in line for line in text.splitlines()) == 1, text
    r = p.r
    looked_up = channel_classify(p.history(), p.people(), r.app_attrs, p.chain(), r.enrolments, r.touches, r.loans,
                                 rules=p.rules, codes=p.codes)
    assert carried.columns == looked_up.columns
    assert sorted(map(str, carried.collect())) == sorted(map(str, looked_up.collect()))
