"""The whole pipeline wired over the role views, one method per stage.

Stages are lazy DataFrames, but with ``materialize=True`` building a stage runs the
jobs that write its shared inputs. Two resolved tables feed most stages: the
accounts with their application and person (``people``) and the application
-> offer -> credit-decision chain (``chain``). With ``materialize=True`` each
is computed once, written as parquet under the cluster's shared checkpoint
folder and read back: later stages then scan a pruned, pushed-down table
instead of repeating the joins of the largest inputs, and the lineage of
every downstream job starts at durable storage, so a lost executor costs a
re-read rather than a re-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import AccountCodes, ChannelRules, Products
from ..session import written
from ..sources.layout import bucketed
from ..sources.roles import Roles
from . import channels, features, history, mart, purchases

AS_OF = "2000-01-01"


class Pipeline:
    def __init__(self, roles: Roles, *, as_of: str = AS_OF, products: Products = Products(),
                 codes: AccountCodes = AccountCodes(), rules: ChannelRules = ChannelRules(),
                 materialize: bool = False, buckets: int | None = None, bucket_rows: int = 100_000):
        self.r = roles
        self.as_of = as_of
        self.products = products
        self.codes = codes
        self.rules = rules
        self.materialize = materialize
        self.buckets = buckets
        self.bucket_rows = bucket_rows
        self._cache: dict[str, DataFrame] = {}

    def _shared(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            df = build()
            self._cache[name] = written(df, name) if self.materialize else df
        return self._cache[name]

    # ------------------------------------------------------- shared inputs
    def people(self) -> DataFrame:
        r = self.r
        return self._shared("people", lambda: history.resolve_people(r.accounts, r.applications, r.borrowers))

    def chain(self) -> DataFrame:
        r = self.r
        return self._shared("chain", lambda: channels.decision_chain(r.app_attrs, r.offers, r.decisions))

    # ------------------------------------------------------------- history
    def history(self, carry: Sequence[str] = ()) -> DataFrame:
        return history.account_history(self.people(), codes=self.codes, carry=carry)

    def counts(self, carry: Sequence[str] = ()) -> DataFrame:
        return history.product_history(self.history(carry), as_of=self.as_of, products=self.products)

    def firstpcl(self) -> DataFrame:
        return history.keep_product(self.counts(), self.products.pcl)

    def _classify(self, base: DataFrame) -> DataFrame:
        r = self.r
        return channels.channel_classify(base, None, r.app_attrs, self.chain(), r.enrolments,
                                         r.touches, r.loans, rules=self.rules, codes=self.codes)

    def channelled(self) -> DataFrame:
        counts = self.counts(channels.ACCOUNT_COLUMNS)
        return self._classify(history.keep_product(counts, self.products.pcl))

    def flags(self) -> DataFrame:
        return purchases.project_flags(self.channelled())

    def channels(self) -> DataFrame:
        """The opened and issued accounts; contract month and channel for those of the PCL product.

        The rows carry what the classification and the previous-products stage read, so they are
        shuffled once on ``id`` and never joined back to ``people``. The 25 counts, which these
        stages do not read, are not computed.
        """
        pcl = F.col("product_type") == F.lit(self.products.pcl)
        return self._classify(self.history(["created_at", *channels.ACCOUNT_COLUMNS])).select(
            "person", "id", "created_at", "product_type", F.when(pcl, F.col("contract_month")).alias("contract_month"),
            F.when(pcl, F.col("pcl_channel")).alias("channel"))

    def previous(self) -> DataFrame:
        return purchases.previous_products(self.channels(), products=self.products, codes=self.codes)

    def repeats(self) -> DataFrame:
        return purchases.repeat_purchase(self.channels(), products=self.products, codes=self.codes)

    # ------------------------------------------------------------ features
    # ``only`` (a one-column frame of line ids) reduces a feature's inputs to those lines
    def deposit(self, only: DataFrame | None = None) -> DataFrame:
        return features.feature_deposit(self.people(), self.r.deposit_apps, self.codes, only)

    def transfers(self, only: DataFrame | None = None) -> DataFrame:
        r = self.r
        return features.feature_transfers(r.lines, r.draw_requests, r.draws, self.codes, only)

    def snapshot(self, only: DataFrame | None = None) -> DataFrame:
        return features.feature_snapshot(self.r.positions, self.as_of, only)

    def prior_accounts(self, only: DataFrame | None = None) -> DataFrame:
        # only account columns are needed: no person resolution
        return features.feature_prior_accounts(self.r.accounts, self.chain(), self.r.prior_accounts, self.codes, only)

    def payment_history(self, only: DataFrame | None = None) -> DataFrame:
        r = self.r
        return features.feature_payment_history(r.accounts, self.chain(), r.prior_accounts,
                                                r.prior_payments, self.codes, only)

    def trade_lines(self, only: DataFrame | None = None) -> DataFrame:
        r = self.r
        return features.feature_trade_lines(r.lines, self.chain(), r.trade_lines, only)

    def autopay(self, only: DataFrame | None = None) -> DataFrame:
        r = self.r
        return features.feature_autopay(r.lines, r.autopay, r.positions, codes=self.codes, only=only)

    # --------------------------------------------------------------- marts
    def front_end(self, only: DataFrame | None = None) -> DataFrame:
        """Q15. With ``buckets`` the driving table and every lookup are written in buckets of the line first; the nine
        tables then meet without a shuffle, in this and in every later run over them. There are ``buckets`` of them, or
        as many more as keep ``bucket_rows`` rows of the largest base table to a bucket: a task joins one bucket
        of each table, so its memory does not grow with the tables."""
        r = self.r
        tables = {"front_end": r.front_end, "cycles": r.cycles, "scores": r.scores}
        tables |= {name: getattr(self, name)(only) for name in mart.FEATURES}
        if self.buckets:
            # the features have one row per line at most
            rows = max(tables[name].count() for name in ("front_end", "cycles", "scores"))
            buckets = max(self.buckets, -(-rows // self.bucket_rows))
            tables = {name: bucketed(df, "loan_id" if name == "scores" else "line_id", buckets, name)
                      for name, df in tables.items()}
        return mart.front_end_mart(**tables, only=only)

    def final(self, limit: int | None = None) -> DataFrame:
        """Q16. With ``materialize`` the repeat purchases are written first, and the front end is
        built for their ids only: every input is reduced to them before it is joined or aggregated."""
        if not self.materialize:
            return mart.final_mart(self.repeats(), self.front_end(), limit=limit)
        repeats = self._shared("repeats", self.repeats)
        return mart.final_mart(repeats, self.front_end(repeats.select("id")), limit=limit)
