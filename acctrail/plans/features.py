"""Q8-Q14: per-credit-line feature tables, each keyed by ``line_id``.

The source pipeline joins every line to *all* rows of its person (deposits)
or applicant (prior accounts, payments) and aggregates afterwards, which
emits |lines| x |rows| pairs per person. Every aggregate used there is
distributive (count of distinct ids per person, sums, maxes, mins), so here
the big side is aggregated per person / applicant / report first (map-side
partial aggregation absorbs hot keys), and the lines then join to one row per
key. The results are identical; no pairs are formed.

Every feature takes ``only``: a one-column frame of line ids. With it, the lines and the big side
are reduced to the rows of those lines (by a semi-join on the line, person,
applicant or report) before anything is aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import ZONE_PST_FIXED, AccountCodes
from ..functions import days_between, first_code, flag, local_date, ratio
from ..operators.heavy import spread_join
from ..operators.joins import keep_keys, left_join
from ..operators.unique import one_per_key

MONEY = "decimal(28,2)"
MONEY4 = "decimal(28,4)"


def pcl_lines(accounts: DataFrame, codes: AccountCodes = AccountCodes()) -> DataFrame:
    """Opened accounts of the PCL program, as ``line_id``."""
    return (accounts.filter((F.col("status") == F.lit(codes.opened))
                            & (F.col("program") == F.lit(codes.pcl_program)))
                    .select(F.col("id").alias("line_id")))


# --------------------------------------------------------------------- Q8
def feature_deposit(people: DataFrame, deposit_apps: DataFrame, codes: AccountCodes = AccountCodes(),
                    only: DataFrame | None = None) -> DataFrame:
    """Q8: the person's opened deposit accounts, per opened PCL line.

    ``people`` is :func:`acctrail.plans.history.resolve_people`.

    cnt_deposit_products (distinct accounts), deposit_opened, premier_savings_flag,
    premier_savings_na, savings_flag, first/last_deposit_open_date.
    """
    lines = (people.filter((F.col("status") == F.lit(codes.opened))
                           & (F.col("program") == F.lit(codes.pcl_program)))
                   .select(F.col("id").alias("line_id"), "person"))
    lines = keep_keys(lines, "line_id", only)
    dap = deposit_apps.select(F.col("account_id").alias("id"), "account_type")
    deposits = people.filter((F.col("status") == F.lit(codes.opened))
                             & (F.col("product_type") == F.lit(codes.deposit_product))
                             & F.col("person").isNotNull())
    if only is not None:
        deposits = keep_keys(deposits, "person", lines.select("person"))
    deposits = (deposits.join(dap, "id", "left")
                        .select("person", F.col("id").alias("account_id"),
                                F.col("created_at").alias("open_date"), "account_type", "program_code"))
    has = F.col("account_id").isNotNull()
    premier = F.col("program_code").isin(*codes.premier_savings_codes)
    per_person = deposits.groupBy("person").agg(
        F.countDistinct("account_id").alias("cnt_deposit_products"),
        F.max(flag(has)).alias("deposit_opened"),
        F.max(flag(has & premier)).alias("premier_savings_flag"),
        F.max(flag(has & ~premier)).alias("premier_savings_na"),
        F.max(flag(has & F.col("account_type").isin(*codes.savings_types))).alias("savings_flag"),
        F.min("open_date").alias("first_deposit_open_date"),
        F.max("open_date").alias("last_deposit_open_date"))
    # lines without a person and lines of one person with many are dealt out over the tasks
    j = spread_join(lines, per_person, ["person"])
    return j.select(
        "line_id",
        F.coalesce("cnt_deposit_products", F.lit(0).cast("long")).alias("cnt_deposit_products"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in
          ("deposit_opened", "premier_savings_flag", "premier_savings_na", "savings_flag")],
        "first_deposit_open_date", "last_deposit_open_date")


# --------------------------------------------------------------------- Q9
def feature_transfers(lines: DataFrame, draw_requests: DataFrame, draws: DataFrame,
                      codes: AccountCodes = AccountCodes(), only: DataFrame | None = None) -> DataFrame:
    """Q9: count and amount of onboarded balance-transfer draws per line.

    The request's external id matches the draw id as text (J5). Draws are
    aggregated per line before they meet the lines table.
    """
    bt = (draw_requests.filter(F.col("draw_source").isin(codes.balance_transfer))
                       .select("line_id", "external_id", "draw_amount"))
    bt = keep_keys(bt, "line_id", only)
    dr = (draws.filter(F.col("draw_status") == F.lit(codes.draw_onboarded))
               .select(F.col("id").cast("string").alias("external_id")))
    per_line = bt.join(dr, "external_id").groupBy("line_id").agg(
        F.count(F.lit(1)).alias("cnt_draws"),
        F.sum("draw_amount").cast(MONEY).alias("bt_amount"))
    return per_line.join(lines.select("line_id"), "line_id", "left_semi")


# -------------------------------------------------------------------- Q10
def feature_snapshot(positions: DataFrame, as_of: str, only: DataFrame | None = None,
                     days: DataFrame | None = None) -> DataFrame:
    """Q10: position snapshot two days before ``as_of``, per line.

    Worst days past due, totals, any-blacklist, averages (NULL when the
    denominator is 0), latest charge-off date; sublines without a term are
    left out. ``days`` (a one-column frame of days, each counted once) takes the place of that day. With positions written by
    :func:`acctrail.sources.layout.by_day`, only the folders of the days asked for are read.
    """
    if days is None:
        p = positions.filter(F.col("processing_date") == F.date_sub(F.lit(as_of).cast("date"), 2))
    else:
        p = keep_keys(positions, "processing_date", days)
    p = p.filter(F.col("term_in_months").isNotNull())
    return keep_keys(p, "line_id", only).groupBy("line_id").agg(
        F.max("days_past_due").alias("days_past_due"),
        F.sum("line_amount").cast(MONEY).alias("sublinetotal"),
        F.max(flag(F.col("is_blacklisted") == F.lit("true"))).alias("blacklist"),
        F.sum("principal_balance").cast(MONEY4).alias("pbal_total"),
        F.sum(F.col("principal_balance") + F.coalesce(F.col("charged_off"), F.lit(0)))
         .cast(MONEY4).alias("pbal_total_inc_chargeoff"),
        ratio(F.sum("line_amount"), F.sum("draw_count")).alias("avg_draw_amt"),
        ratio(F.sum("line_amount"), F.count("subline_id")).alias("avg_subline_amt"),
        F.max("charge_off_date").alias("charge_off_date"))


# -------------------------------------------------------------------- Q11
def _line_applicants(accounts: DataFrame, chain: DataFrame, codes: AccountCodes,
                     only: DataFrame | None = None) -> DataFrame:
    c = keep_keys(chain.select(F.col("app_id").alias("line_id"), "applicant_id"), "line_id", only)
    return keep_keys(pcl_lines(accounts, codes), "line_id", only).join(c, "line_id", "left")


def feature_prior_accounts(accounts: DataFrame, chain: DataFrame, prior_accounts: DataFrame,
                           codes: AccountCodes = AccountCodes(), only: DataFrame | None = None) -> DataFrame:
    """Q11: the applicant's prior accounts, per opened PCL line.

    ``accounts`` needs only id, status and program (the accounts table, or
    the resolved people table).
    ``chain`` is :func:`acctrail.plans.channels.decision_chain` (line ->
    credit decision -> applicant).

    open_prior_pcl, open_prior_pl, pl_pbal, paidoff, existingpl,
    priorpcl_contractdate, priorpcl_reward_program_code (first listed code).
    """
    prog, serv, status = F.col("program"), F.col("servicing_status"), F.col("status")
    pcl = prog == F.lit(codes.pcl_program)
    pl = prog.isin(*codes.pl_programs)
    opened = serv == F.lit(codes.servicing_open)
    issued = status.isin(*codes.prior_issued_statuses)
    paid = serv == F.lit(codes.servicing_paidoff)
    lines = _line_applicants(accounts, chain, codes, only)
    # accounts of other programs change no column: left out at the scan
    prior = prior_accounts.filter(F.col("applicant_id").isNotNull() & (pcl | pl))
    if only is not None:
        prior = keep_keys(prior, "applicant_id", lines.select("applicant_id"))
    # the maximum over a string would sort all rows for the numeric sums: it is taken apart, over its own rows
    rewards = (prior.filter(pcl & F.col("reward_codes").isNotNull()).groupBy("applicant_id")
               .agg(F.max(first_code("reward_codes")).alias("priorpcl_reward_program_code")))
    per_app = prior.groupBy("applicant_id").agg(
        F.sum(flag(pcl & opened & status.isin(*codes.prior_open_statuses))).alias("open_prior_pcl"),
        F.sum(flag(pl & opened & issued)).alias("open_prior_pl"),
        F.sum(F.when(pl & opened, F.col("principal_balance")).otherwise(F.lit(0))).alias("pl_pbal"),
        F.max(flag(pl & paid)).alias("paidoff"),
        F.max(flag((pl & issued & (serv != F.lit(codes.servicing_chargeoff))) | (pl & paid)))
         .alias("existingpl"),
        F.max(F.when(pcl & serv.isNotNull(), F.col("contract_date"))).alias("priorpcl_contractdate"))
    per_app = per_app.join(rewards, "applicant_id", "left")
    j = left_join(lines, per_app.withColumnRenamed("applicant_id", "_ap"), "applicant_id", "_ap", salt="line_id")
    return j.groupBy("line_id").agg(
        F.coalesce(F.sum("open_prior_pcl"), F.lit(0).cast("long")).alias("open_prior_pcl"),
        F.coalesce(F.sum("open_prior_pl"), F.lit(0).cast("long")).alias("open_prior_pl"),
        F.coalesce(F.sum("pl_pbal"), F.lit(0)).cast(MONEY).alias("pl_pbal"),
        F.coalesce(F.max("paidoff"), F.lit(0)).alias("paidoff"),
        F.coalesce(F.max("existingpl"), F.lit(0)).alias("existingpl"),
        F.max("priorpcl_contractdate").alias("priorpcl_contractdate"),
        F.max("priorpcl_reward_program_code").alias("priorpcl_reward_program_code"))


# -------------------------------------------------------------------- Q12
GOOD_PAYMENT_DAYS = 15
LAST_BILLS = 3


def last_bills_good_count(prior_payments: DataFrame, k: int = LAST_BILLS,
                          good_days: int = GOOD_PAYMENT_DAYS) -> DataFrame:
    """Per prior account: payments within ``good_days`` of due among bills ranked <= k.

    Rank is ``rank()`` by due date descending (NULL first, ties share a rank).
    Computed on one row per (account, due date): the rank of a due date is 1 +
    the number of bills due later, so ties never need to meet in one task.
    """
    good = flag(days_between("paid_date", "due_date") <= F.lit(good_days))
    by_due = prior_payments.groupBy("prior_account_id", "due_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(good).alias("good"))
    w = (Window.partitionBy("prior_account_id").orderBy(F.col("due_date").desc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    ranked = by_due.withColumn("bill_rank", F.lit(1) + F.coalesce(F.sum("n").over(w), F.lit(0)))
    return (ranked.filter(F.col("bill_rank") <= k)
                  .groupBy("prior_account_id").agg(F.sum("good").alias("good3pmt_count")))


def feature_payment_history(accounts: DataFrame, chain: DataFrame, prior_accounts: DataFrame,
                            prior_payments: DataFrame, codes: AccountCodes = AccountCodes(),
                            only: DataFrame | None = None) -> DataFrame:
    """Q12: per opened PCL line, the fewest good payments among the last 3 bills
    of any open prior personal loan of the applicant (lines without one are absent)."""
    lines = _line_applicants(accounts, chain, codes, only)
    open_pl = (prior_accounts.filter(F.col("program").isin(*codes.pl_programs)
                                     & (F.col("servicing_status") == F.lit(codes.servicing_open)))
                             .select(F.col("id").alias("prior_account_id"), "applicant_id", "prior_lir_id"))
    if only is not None:
        open_pl = keep_keys(open_pl, "applicant_id", lines.select("applicant_id"))
    # only the bills of those accounts are grouped and ranked
    good3 = last_bills_good_count(keep_keys(prior_payments, "prior_account_id", open_pl.select("prior_account_id")))
    per_prior = (open_pl.join(good3, "prior_account_id", "left")
                        .groupBy("applicant_id", "prior_lir_id")
                        .agg(F.sum(F.coalesce(F.col("good3pmt_count"), F.lit(0).cast("long")))
                             .alias("good3pmt_count")))
    per_app = per_prior.groupBy("applicant_id").agg(F.min("good3pmt_count").alias("good3pmt_count"))
    return (lines.join(per_app, "applicant_id", "inner")
                 .groupBy("line_id").agg(F.min("good3pmt_count").alias("good3pmt_count")))


# -------------------------------------------------------------------- Q13
REVOLVING = "revolving"
# fixed values: bureau account classes and the authorised-user designator
REV_BALANCE_ACCOUNTS = ("CC", "FX")
SC_ACCOUNT, BC_ACCOUNT = "SC", "BC"
AUTH_USER = "authorizedUser"


def trade_line_sums(trade_lines: DataFrame) -> DataFrame:
    """Per credit report: open revolving trade-line counts, balances and limits."""
    open_rev = (F.col("portfolio_type") == F.lit(REVOLVING)) & F.col("date_closed").isNull()
    acct = F.col("account")

    def s(pred: Column, value: Column | None) -> Column:
        v = F.lit(1) if value is None else value
        return F.sum(F.when(open_rev & pred, v).otherwise(F.lit(0)))

    bal, lim = F.col("balance"), F.col("credit_limit")
    rev, sc, bc = acct.isin(*REV_BALANCE_ACCOUNTS), acct == F.lit(SC_ACCOUNT), acct == F.lit(BC_ACCOUNT)
    au = F.col("ecoa") == F.lit(AUTH_USER)
    return trade_lines.groupBy("report_id").agg(
        s(rev, bal).alias("rev_balance"), s(rev, lim).alias("rev_credit_limit"),
        s(sc, None).alias("sc_cnt_orig"), s(bc, None).alias("bc_cnt_orig"),
        s(sc, bal).alias("sc_bal_orig"), s(bc, bal).alias("bc_bal_orig"),
        s(sc, lim).alias("sc_cl_orig"), s(bc, lim).alias("bc_cl_orig"),
        s(au, None).alias("auth_user_orig"), s(au, bal).alias("auth_user_orig_balance"),
        s(au, lim).alias("auth_user_orig_credit"))


TRADE_COLUMNS = [
    ("rev_balance", "rev_balance", MONEY), ("rev_credit_limit", "rev_credit_limit", MONEY),
    ("sc_cnt_orig", "sc_cnt_orig", "long"), ("bc_cnt_orig", "bc_cnt_orig", "long"),
    ("sc_bal_orig", "sc_bal_orig", MONEY), ("bc_bal_orig", "bc_bal_orig", MONEY),
    ("sc_cl_orig", "sc_cl_orig", MONEY), ("bc_cl_orig", "bc_cl_orig", MONEY),
    # the source keeps these as duplicates of the three SC measures
    ("sc_orig", "sc_cnt_orig", "long"), ("sc_orig_balance", "sc_bal_orig", MONEY),
    ("sc_orig_credit", "sc_cl_orig", MONEY),
    ("auth_user_orig", "auth_user_orig", "long"), ("auth_user_orig_balance", "auth_user_orig_balance", MONEY),
    ("auth_user_orig_credit", "auth_user_orig_credit", MONEY),
]


def feature_trade_lines(lines: DataFrame, chain: DataFrame, trade_lines: DataFrame,
                        only: DataFrame | None = None) -> DataFrame:
    """Q13: trade-line measures per (credit decision, line).

    Trade lines are summed per credit report first; the line -> application ->
    offer -> decision chain then picks the report (inner joins throughout).
    """
    keyed = (keep_keys(lines.select("line_id"), "line_id", only)
                  .join(keep_keys(chain, "app_id", only), F.col("line_id") == F.col("app_id"), "inner")
                  .select("decision_id", "line_id", "report_id"))
    if only is not None:
        trade_lines = keep_keys(trade_lines, "report_id", keyed.select("report_id"))
    # cluster by line_id before grouping by (decision_id, line_id): the rows are
    # already one per report, and the mart then joins on line_id without a reshuffle
    j = keyed.join(trade_line_sums(trade_lines), "report_id", "inner").repartition("line_id")
    return j.groupBy("decision_id", "line_id").agg(
        *[F.sum(src).cast(t).alias(name) for name, src, t in TRADE_COLUMNS])


# -------------------------------------------------------------------- Q14
AUTOPAY_WINDOWS = (30, 60, 90, 120, 180, 240)
FIRST_PAYMENT_GRACE_DAYS = 5


def feature_autopay(lines: DataFrame, autopay: DataFrame, positions: DataFrame, *,
                    codes: AccountCodes = AccountCodes(), zone: str = ZONE_PST_FIXED,
                    only: DataFrame | None = None) -> DataFrame:
    """Q14: autopay enrolment and cancellation timing per line.

    Dates are taken in ``zone``. ``ap_enrl_cancel_first_payment`` compares with
    the stored first-payment due date (the input column of that name, D11),
    and is 0 when there is no autopay status. ``autopay`` must have one row per line, or the run fails and names it.
    """
    lines, autopay, positions = (keep_keys(t, "line_id", only) for t in (lines, autopay, positions))
    sub = positions.groupBy("line_id").agg(F.min("expected_first_payment").alias("first_due_raw"))
    ap = one_per_key(autopay.select("line_id", "status", "authorized", "cancelled"), "line_id", "autopay")
    a = lines.join(ap, "line_id", "left").join(sub, "line_id", "left")
    auth = local_date("authorized", zone)
    canc = local_date("cancelled", zone)
    cdate = F.col("contract_date")
    d_enr = days_between(auth, cdate)
    d_can = days_between(canc, auth)
    raw_due = F.col("first_due_raw")
    # CASE WHEN <any> THEN 0 ELSE 1: a NULL condition also gives 1
    not_first_payment = ((canc <= F.date_add(raw_due, FIRST_PAYMENT_GRACE_DAYS)) | (auth >= raw_due)
                         | F.col("status").isNull())
    return a.select(
        *lines.columns,
        flag(F.col("status") == F.lit(codes.autopay_active)).alias("ap_enrolled"),
        "status",
        auth.alias("autopay_authorization_date"),
        canc.alias("autopay_cancellation_date"),
        local_date(raw_due, zone).alias("first_payment_due_date"),
        d_enr.alias("days_diff_ap_enrolled"),
        flag(canc.isNotNull()).alias("ap_cancelled"),
        d_can.alias("days_diff_ap_cancelled"),
        F.coalesce(d_enr, d_can, F.lit(0)).alias("days_diff_ap_enrl_cancel"),
        *[flag((days_between(canc, cdate) <= n) | (d_enr <= n)).alias(f"ap_enrl_cancel_{n}_days")
          for n in AUTOPAY_WINDOWS],
        F.when(not_first_payment, F.lit(0)).otherwise(F.lit(1)).alias("ap_enrl_cancel_first_payment"),
        flag(F.col("autopay_orig") == F.lit("true")).alias("autopay_origination"),
        flag(raw_due.isNull()).alias("no_activity"))
