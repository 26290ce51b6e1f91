"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each query reads the role views over the given tables (whole tables, no
sampling or row caps) and runs the library's operators on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..codes import Products
from ..operators.ordered import product_history_counts
from ..sources.roles import Roles
from . import history as H

AS_OF = "2000-01-01"

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(key: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[key] = fn
        return fn
    return deco


def registry() -> dict[str, QueryFn]:
    from . import ops  # noqa: F401  (registers the operator-level queries)
    return dict(_REGISTRY)


def _hist(spark, sf_dir, materialize: bool = False):
    """The account history. ``materialize=True`` when the caller reads it several
    times (the count operators read it for the day histogram, the hot-block
    detection and the row windows): the resolved people table is then written
    once instead of its joins being planned again for each branch."""
    if materialize:
        return _pipe(spark, sf_dir, materialize=True).history()
    return H.history_from_roles(Roles(spark, sf_dir))


@register("account_history")
def q_account_history(spark, sf_dir):
    """Q1: opened/issued accounts -> person and local creation date."""
    return _hist(spark, sf_dir)


@register("product_history_counts")
def q_product_history_counts(spark, sf_dir):
    """Q2: all 25 product-history counts per account."""
    return H.product_history(_hist(spark, sf_dir, materialize=True), as_of=AS_OF)


def _only(include, doc):
    def q(spark, sf_dir):
        return product_history_counts(_hist(spark, sf_dir, materialize=True), as_of=AS_OF, include=include)
    q.__doc__ = doc
    return q


register("product_history_prior")(_only(
    ("orig",), "W5: per account, the person's earlier accounts in (day, id) order, per known product."))


def _months(n):
    def q(spark, sf_dir):
        return product_history_counts(_hist(spark, sf_dir, materialize=True), include=("months",),
                                      horizons=(n,))
    q.__doc__ = f"W6: per account, the person's accounts dated before add_months(day, {n}) (strict)."
    return q


register("product_history_3m")(_months(3))
register("product_history_6m")(_months(6))
register("product_history_12m")(_months(12))
register("product_history_today")(_only(
    ("today",), "W7: per account, the person's accounts dated before the as-of date."))


@register("product_history_pcl")
def q_product_history_pcl(spark, sf_dir):
    """Q3: the counts, kept for PCL accounts only."""
    counts = H.product_history(_hist(spark, sf_dir, materialize=True), as_of=AS_OF)
    return H.keep_product(counts, Products().pcl)


def _pipe(spark, sf_dir, materialize: bool = False):
    """The pipeline over the role views. Composed stages read the resolved
    people and decision-chain tables several times, so they ask for them to be
    written once to the shared checkpoint folder (``materialize=True``)."""
    from .pipeline import Pipeline
    return Pipeline(Roles(spark, sf_dir), as_of=AS_OF, materialize=materialize)


@register("channel_classify")
def q_channel_classify(spark, sf_dir):
    """Q4: acquisition channel of each PCL account."""
    return _pipe(spark, sf_dir, materialize=True).channelled()


@register("project_flags")
def q_project_flags(spark, sf_dir):
    """Q5: counts with multi-product flags."""
    return _pipe(spark, sf_dir, materialize=True).flags()


@register("previous_products")
def q_previous_products(spark, sf_dir):
    """Q6: previous five products, dates, gaps and channels per account."""
    return _pipe(spark, sf_dir, materialize=True).previous()


@register("repeat_purchase")
def q_repeat_purchase(spark, sf_dir):
    """Q7: PCL accounts with an earlier PCL among the previous five."""
    return _pipe(spark, sf_dir, materialize=True).repeats()


@register("feature_deposit")
def q_feature_deposit(spark, sf_dir):
    """Q8: person's deposit accounts per PCL line."""
    return _pipe(spark, sf_dir, materialize=True).deposit()


@register("feature_transfers")
def q_feature_transfers(spark, sf_dir):
    """Q9: onboarded balance-transfer draws per line."""
    return _pipe(spark, sf_dir).transfers()


@register("feature_snapshot")
def q_feature_snapshot(spark, sf_dir):
    """Q10: position snapshot at as_of - 2 per line."""
    return _pipe(spark, sf_dir).snapshot()


@register("feature_snapshot_by_day")
def q_feature_snapshot_by_day(spark, sf_dir):
    """Q10 over positions in one folder per day: only the snapshot day's folder is read."""
    from ..sources.layout import by_day
    from .features import feature_snapshot
    return feature_snapshot(by_day(Roles(spark, sf_dir).positions, "processing_date"), AS_OF)


@register("feature_prior_accounts")
def q_feature_prior_accounts(spark, sf_dir):
    """Q11: applicant's prior accounts per PCL line."""
    return _pipe(spark, sf_dir).prior_accounts()


@register("feature_payment_history")
def q_feature_payment_history(spark, sf_dir):
    """Q12: good payments among the last three bills."""
    return _pipe(spark, sf_dir).payment_history()


@register("feature_trade_lines")
def q_feature_trade_lines(spark, sf_dir):
    """Q13: trade-line measures per decision and line."""
    return _pipe(spark, sf_dir).trade_lines()


@register("feature_autopay")
def q_feature_autopay(spark, sf_dir):
    """Q14: autopay enrolment / cancellation timing per line."""
    return _pipe(spark, sf_dir).autopay()


@register("mart_front_end")
def q_mart_front_end(spark, sf_dir):
    """Q15: front-end mart: driving lines + features + bands."""
    return _pipe(spark, sf_dir, materialize=True).front_end()


@register("mart_front_end_bucketed")
def q_mart_front_end_bucketed(spark, sf_dir):
    """Q15 over tables bucketed by line: nine joins without a shuffle."""
    from .pipeline import Pipeline
    return Pipeline(Roles(spark, sf_dir), as_of=AS_OF, materialize=True, buckets=8).front_end()


@register("mart_repeat_purchase")
def q_mart_repeat_purchase(spark, sf_dir):
    """Q16: repeat purchases left-joined to the front-end mart."""
    return _pipe(spark, sf_dir, materialize=True).final()
