"""Role views: the input tables the pipeline expects, as stand-ins over the test tables.

Each role is ``SELECT <columns> FROM <base>``. The column texts are plain SQL
that Spark and DuckDB parse alike, so the oracle uses the very same inputs.
A role view only renames and relabels columns of one base table; it does no
part of the pipeline's work, and every row of the base table appears.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import load

ROLES: dict[str, tuple[str, list[str]]] = {
    # loan-in-review: one row per account the customer opened or applied for
    "accounts": ("orders", [
        "o_orderkey AS id",
        # some accounts carry no creation date
        "CASE WHEN o_orderkey % 97 <> 5 THEN o_orderdate END AS created_at",
        "CAST(CASE WHEN o_orderkey % 97 <> 5 THEN o_orderdate END AS DATE) AS created",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'PCL' WHEN '2-HIGH' THEN 'PL' "
        "WHEN '3-MEDIUM' THEN 'DEP' WHEN '4-NOT SPECIFIED' THEN 'HM' ELSE 'OTHER' END AS product_type",
        "CASE o_orderstatus WHEN 'F' THEN 'OPENED' WHEN 'O' THEN 'ISSUED' ELSE 'DECLINED' END AS status",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'PCL' WHEN '2-HIGH' THEN 'CORE' ELSE 'OTHER' END AS program",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'DEP_SV_01' ELSE 'DEP_CK_01' END AS program_code",
        "CAST(CASE WHEN o_orderkey % 13 > 0 THEN 550 + o_orderkey % 300 END AS INT) AS fico_score",
    ]),
    "applications": ("orders", [
        "o_orderkey AS id",
        "o_custkey AS borrower_id",
        "CASE WHEN o_orderkey % 9 = 0 THEN 'INTERNAL' ELSE 'CUSTOMER' END AS initiator",
    ]),
    # two customers share one person, so a person spans borrower records
    "borrowers": ("customer", [
        "c_custkey AS id",
        "CAST(c_custkey - c_custkey % 2 AS STRING) AS person",
    ]),
    "app_attrs": ("orders", [
        "o_orderkey AS app_id",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'true' ELSE 'false' END AS is_direct_mail",
        "CASE o_orderkey % 7 WHEN 0 THEN 'partner_a' WHEN 1 THEN 'x_ub1' WHEN 2 THEN '' "
        "WHEN 3 THEN NULL WHEN 4 THEN 'xub' ELSE 'search' END AS utm_source",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'false' ELSE 'true' END AS good_source",
        "CASE o_orderkey % 13 WHEN 0 THEN 'REF_A' WHEN 1 THEN 'XREF_BX' WHEN 2 THEN 'REF_CARD' "
        "ELSE NULL END AS api_referrer",
        "CASE o_orderkey % 5 WHEN 0 THEN 'PHONE' WHEN 1 THEN 'WEB' ELSE NULL END AS source_system",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'PCL' WHEN '2-HIGH' THEN 'CORE' ELSE 'OTHER' END AS program",
        "o_orderkey + 1 AS offer_id",
    ]),
    # NULL keys on purpose: they never match
    "enrolments": ("orders", [
        "CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey ELSE NULL END AS account_id",
        "CASE WHEN o_orderkey % 12 = 0 THEN 'ENROLLED' ELSE 'CANCELLED' END AS status",
    ]),
    "touches": ("events", [
        "event_id",
        "user_id AS asset_id",
        "ts AS updated_at",
        # a source spelled otherwise than the excluded one keeps its code
        "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Error' ELSE event_type END AS utm_source",
        "CASE WHEN event_id % 3 = 0 THEN 'app_create' ELSE 'other' END AS event",
    ]),
    "offers": ("orders", [
        "o_orderkey + 1 AS id",
        "o_orderkey + 2 AS decision_id",
    ]),
    "decisions": ("orders", [
        "o_orderkey + 2 AS id",
        "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey ELSE NULL END AS prior_loan_id",
        "o_custkey AS applicant_id",
        "o_orderkey AS report_id",
    ]),
    "loans": ("orders", [
        "o_orderkey AS loan_id",
        "CASE o_orderstatus WHEN 'F' THEN 'ISSUED' WHEN 'O' THEN 'REISSUED' ELSE 'CLOSED' END AS loan_status",
    ]),
    # driving table of the front-end mart: one row per credit line
    "front_end": ("orders", [
        "o_orderkey AS line_id",
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_custkey % 35 AS DOUBLE) / 100 END AS score",
        "o_orderdate AS contract_at",
    ]),
    "cycles": ("orders", [
        "o_orderkey AS line_id",
        "o_orderkey % 3 AS mob",
        "o_orderdate AS contract_at",
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN CAST(125000 AS DOUBLE) "
        "ELSE o_totalprice / 2 END AS income",
        "o_totalprice / 12 AS fcf_stated",
        "o_totalprice / 15 AS fcf_verified",
        "o_orderkey % 5 AS draw_cnt",
        "o_orderkey % 4 AS card_cnt",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'CB15' ELSE NULL END AS prior_reward_code",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'CB15' ELSE 'TR' END AS enroll_reward_code",
        "CASE o_orderkey % 5 WHEN 0 THEN 'CB15' WHEN 1 THEN NULL ELSE 'TR' END AS funnel_reward_code",
    ]),
    "scores": ("orders", [
        "o_orderkey AS loan_id",
        "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 40 - 2 AS DOUBLE) / 100 END AS score",
    ]),
    "positions": ("lineitem", [
        "l_orderkey AS line_id",
        "l_linenumber AS subline_id",
        "CAST(l_shipdate AS DATE) AS processing_date",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount",
        "CAST(l_quantity AS INTEGER) % 4 AS draw_count",
        "CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE NULL END AS charged_off",
        "CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) ELSE NULL END AS charge_off_date",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) "
        "AS DECIMAL(18,4)) AS principal_balance",
        "l_linenumber * 7 AS days_past_due",
        "CASE WHEN l_tax > 0.05 THEN 'true' ELSE 'false' END AS is_blacklisted",
        "CASE WHEN l_discount > 0.09 THEN NULL ELSE l_linenumber * 12 END AS term_in_months",
        "CAST(l_shipdate AS DATE) + 30 AS expected_first_payment",
    ]),
    "deposit_apps": ("orders", [
        "o_orderkey AS account_id",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type",
    ]),
    "draw_requests": ("events", [
        "user_id AS line_id",
        "CASE WHEN event_type = 'purchase' THEN 'BALANCE_TRANSFER' ELSE 'CARD' END AS draw_source",
        "CAST(event_id AS STRING) AS external_id",
        "CAST(value AS DECIMAL(18,2)) AS draw_amount",
    ]),
    "draws": ("events", [
        "event_id AS id",
        "CASE WHEN event_id % 5 = 0 THEN 'PENDING' ELSE 'ONBOARDED' END AS draw_status",
    ]),
    "prior_accounts": ("orders", [
        "o_orderkey AS id",
        "o_custkey AS applicant_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'PCL' WHEN '2-HIGH' THEN 'CORE' ELSE 'OTHER' END AS program",
        "CASE o_orderstatus WHEN 'F' THEN 'OPEN' WHEN 'O' THEN 'CLOSED_PAIDOFF' "
        "ELSE 'CLOSED_CHARGEOFF' END AS servicing_status",
        "CASE o_orderkey % 4 WHEN 0 THEN 'OPENED' WHEN 1 THEN 'ISSUED' WHEN 2 THEN 'Reissued' "
        "ELSE 'DECLINED' END AS status",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS principal_balance",
        "CAST(o_orderdate AS DATE) AS contract_date",
        "CASE o_orderkey % 4 WHEN 0 THEN '[\"CB15\",\"TR\"]' WHEN 1 THEN '[\"TR\"]' WHEN 2 THEN '[]' "
        "ELSE NULL END AS reward_codes",
        "o_orderkey AS prior_lir_id",
    ]),
    "prior_payments": ("lineitem", [
        "l_orderkey AS prior_account_id",
        "CAST(l_shipdate AS DATE) AS due_date",
        "CAST(l_shipdate AS DATE) + l_linenumber * 5 AS paid_date",
    ]),
    "trade_lines": ("lineitem", [
        "l_orderkey AS report_id",
        "CASE WHEN l_linestatus = 'O' THEN 'revolving' ELSE 'installment' END AS portfolio_type",
        "CASE l_returnflag WHEN 'A' THEN 'SC' WHEN 'N' THEN 'BC' ELSE 'CC' END AS account",
        "CASE WHEN l_tax > 0.05 THEN CAST(l_shipdate AS DATE) ELSE NULL END AS date_closed",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS balance",
        "CAST(l_quantity * 1000 AS DECIMAL(18,2)) AS credit_limit",
        "CASE WHEN l_linenumber = 1 THEN 'authorizedUser' ELSE 'individual' END AS ecoa",
    ]),
    "lines": ("orders", [
        "o_orderkey AS line_id",
        "CAST(o_orderdate AS DATE) AS contract_date",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS autopay_orig",
    ]),
    "autopay": ("orders", [
        "o_orderkey AS line_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'ACTIVE' WHEN o_orderkey % 3 = 1 THEN 'CANCELLED' ELSE NULL END AS status",
        "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INTEGER) AS authorized",
        "CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 + 20 AS INTEGER) "
        "ELSE NULL END AS cancelled",
    ]),
}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, cols = ROLES[name]
    return load(spark, sf_dir, base).selectExpr(*cols)


class Roles:
    """Lazy accessor: ``Roles(spark, sf_dir).accounts`` etc.

    Each base table is opened once (one footer/schema read) and each role view
    built once; DataFrames are immutable, so every stage can share them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._bases: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        if table not in self._bases:
            self._bases[table] = load(self.spark, self.sf_dir, table)
        return self._bases[table]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in ROLES:
            raise AttributeError(name)
        if name not in self._views:
            base, cols = ROLES[name]
            self._views[name] = self.base(base).selectExpr(*cols)
        return self._views[name]


def role_cte(name: str) -> str:
    """The same role as a SQL CTE body (used by the DuckDB oracle)."""
    base, cols = ROLES[name]
    return f"{name} AS (SELECT {', '.join(cols)} FROM {base})"
