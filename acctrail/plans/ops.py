"""Operator-level queries: one registered query per operator of the inventory.

Each reads whole role views (no sampling, no row caps) and runs one library
operator on them, so a regression in one operator shows up on its own key.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codes import ZONE_LOS_ANGELES, ZONE_PST_FIXED, AccountCodes, ChannelRules, Products
from ..functions import (cashflow_band, classify, days_between, days_between_band, first_code, flag,
                         income_band, local_date, null_or_ne, ratio, score_band_coarse,
                         score_band_fine, usage_mix, year_month)
from ..operators.firsts import latest_k
from ..operators.joins import left_anti_join, left_join
from ..operators.ordered import horizon_counts_merge
from ..session import fresh_dir, written
from ..sources import files
from ..sources.roles import Roles
from .catalog import AS_OF, _hist, _pipe, register
from .channels import first_touch

C = AccountCodes()
R = ChannelRules()
P = Products()


# ------------------------------------------------------------- sources / sinks
@register("scan_accounts")
def q_scan_accounts(spark, sf_dir):
    """Pruned scan of a named table through its role view."""
    return Roles(spark, sf_dir).accounts


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Write the PCL counts as CSV (date column renamed), read them
    back with the fixed schema, rename the column back."""
    schema = files.HISTORY_SCHEMA
    renamed = T.StructType([f if f.name != "created" else T.StructField("Date", f.dataType)
                            for f in schema.fields])
    counts = _pipe(spark, sf_dir, materialize=True).firstpcl().withColumnRenamed("created", "Date")
    path = files.write_history_csv(counts, fresh_dir(spark, "csv_roundtrip"), renamed)
    back = files.read_csv(spark, path, renamed)
    return back.withColumnRenamed("Date", "created")


def _load_file(counts, foreign_product: str | None):
    """Write the history counts as CSV text lines; dates are ISO except, when
    ``foreign_product`` is given, that product's rows carry a US-style date."""
    date_txt = F.date_format("created", "yyyy-MM-dd")
    if foreign_product is not None:
        date_txt = F.when(F.col("product_type") == F.lit(foreign_product),
                          F.date_format("created", "MM/dd/yyyy")).otherwise(date_txt)
    text = counts.select(*[date_txt.alias("created") if c == "created" else F.col(c).cast("string")
                           for c in counts.columns])
    return files.write_history_csv(text, fresh_dir(counts.sparkSession, "history_load"))


@register("csv_typed_load")
def q_csv_typed_load(spark, sf_dir):
    """S3, P5: typed load of the 29-column history file (header skipped, text
    dates parsed to DATE)."""
    path = _load_file(_pipe(spark, sf_dir, materialize=True).counts(), None)
    good, _ = files.split_rejects(files.load_typed_csv(spark, path))
    return good


@register("csv_load_rejects")
def q_csv_load_rejects(spark, sf_dir):
    """The rejected lines of a load whose dated unknown-product rows carry
    a date the declared format cannot parse; an empty date is a NULL, no reject."""
    path = _load_file(_pipe(spark, sf_dir, materialize=True).counts(), "OTHER")
    _, bad = files.split_rejects(files.load_typed_csv(spark, path))
    return bad


@register("csv_reject_log")
def q_csv_reject_log(spark, sf_dir):
    """The log of two loads of the history, newest first; in the first the unknown product's dates
    cannot be parsed, in the second those of the mortgage rows."""
    counts = written(_pipe(spark, sf_dir, materialize=True).counts(), "counts")
    log = fresh_dir(spark, "reject_log")
    for load_id, product in (("load1", "OTHER"), ("load2", P.hm)):
        files.log_rejects(spark, _load_file(counts, product), log, load_id)
    return files.reject_log(spark, log).select("load_id", "raw_line", "reason")


@register("union_all_outputs")
def q_union_all_outputs(spark, sf_dir):
    """Counts written as two partial outputs (before the as-of date / from
    it or without a date), merged back by one multi-path read."""
    counts = _pipe(spark, sf_dir, materialize=True).counts()
    before = F.coalesce(F.col("created") < F.lit(AS_OF).cast("date"), F.lit(False))
    p1 = files.write_history_csv(counts.filter(before), fresh_dir(spark, "out_part"))
    p2 = files.write_history_csv(counts.filter(~before), fresh_dir(spark, "out_part"))
    return files.merge_outputs(spark, [p1, p2], files.HISTORY_SCHEMA)


@register("ctas_roundtrip")
def q_ctas_roundtrip(spark, sf_dir):
    """Materialize the final mart twice to one target (replace, not
    append) and read the table back."""
    mart = _pipe(spark, sf_dir, materialize=True).final()
    path = fresh_dir(spark, "ctas")
    files.publish(mart, path)
    files.publish(mart, path)
    return files.current(spark, path)


# -------------------------------------------------------- projections / filters
@register("star_plus_derived")
def q_star_plus_derived(spark, sf_dir):
    """All columns plus derived local date and month."""
    a = Roles(spark, sf_dir).accounts
    local = local_date("created_at", ZONE_LOS_ANGELES)
    return a.select("*", local.alias("local_created"), year_month(local).alias("local_month"))


@register("lateral_alias_flags")
def q_lateral_alias_flags(spark, sf_dir):
    """Later columns built on earlier derived ones (share -> flag -> label)."""
    c = Roles(spark, sf_dir).cycles
    return (c.withColumn("card_share", ratio("card_cnt", "draw_cnt"))
             .withColumn("card_heavy", flag(F.col("card_share") >= 0.5))
             .withColumn("card_mix", classify([(F.col("card_heavy") == 1, "card"),
                                               (F.col("card_share").isNotNull(), "ach")], "none"))
             .select("line_id", "card_share", "card_heavy", "card_mix"))


@register("filter_product")
def q_filter_product(spark, sf_dir):
    """Equality filter."""
    return Roles(spark, sf_dir).accounts.filter(F.col("product_type") == F.lit(P.pcl))


@register("filter_status_in")
def q_filter_status_in(spark, sf_dir):
    """IN-list filter."""
    return Roles(spark, sf_dir).accounts.filter(F.col("status").isin(C.opened, C.issued))


@register("filter_null_or_ne")
def q_filter_null_or_ne(spark, sf_dir):
    """NULL-or-different filter."""
    return Roles(spark, sf_dir).app_attrs.filter(null_or_ne("source_system", R.phone_source_system))


@register("filter_like")
def q_filter_like(spark, sf_dir):
    """LIKE with '%' and the one-character '_' wildcard."""
    a = Roles(spark, sf_dir).app_attrs
    return a.filter(F.col("utm_source").like(R.high_risk_source_like)
                    | F.col("api_referrer").like(R.high_risk_referrer_like))


@register("flag_same_value")
def q_flag_same_value(spark, sf_dir):
    """0/1 equality flags of two columns (NULL gives 0)."""
    c = Roles(spark, sf_dir).cycles
    return c.select("line_id",
                    flag(F.col("prior_reward_code") == F.col("enroll_reward_code")).alias("same_enroll"),
                    flag(F.col("prior_reward_code") == F.col("funnel_reward_code")).alias("same_funnel"))


# ------------------------------------------------------------------------ bands
@register("band_score_fine")
def q_band_score_fine(spark, sf_dir):
    """B1: fine score band."""
    s = Roles(spark, sf_dir).scores
    return s.select("loan_id", "score", score_band_fine("score").alias("band"))


@register("band_score_coarse")
def q_band_score_coarse(spark, sf_dir):
    """B2: coarse score band."""
    s = Roles(spark, sf_dir).front_end
    return s.select("line_id", "score", score_band_coarse("score").alias("band"))


@register("band_income")
def q_band_income(spark, sf_dir):
    """Income band."""
    c = Roles(spark, sf_dir).cycles
    return c.select("line_id", "income", income_band("income").alias("band"))


@register("band_cashflow")
def q_band_cashflow(spark, sf_dir):
    """Cash-flow bands of two columns."""
    c = Roles(spark, sf_dir).cycles
    return c.select("line_id", cashflow_band("fcf_stated").alias("stated_band"),
                    cashflow_band("fcf_verified").alias("verified_band"))


@register("band_days_between")
def q_band_days_between(spark, sf_dir):
    """Band of the days between a prior account's contract and each due date."""
    r = Roles(spark, sf_dir)
    pa = r.prior_accounts.select(F.col("id").alias("prior_account_id"), "contract_date")
    j = r.prior_payments.join(pa, "prior_account_id", "inner")
    days = days_between("due_date", "contract_date")
    return j.select("prior_account_id", "due_date", days.alias("days"), days_between_band(days).alias("band"))


@register("usage_mix_label")
def q_usage_mix_label(spark, sf_dir):
    """Draw usage label from transfers and card share."""
    p = _pipe(spark, sf_dir)
    c = p.r.cycles.select("line_id", "draw_cnt", "card_cnt")
    j = c.join(p.transfers().select("line_id", "bt_amount"), "line_id", "left")
    return j.select("line_id", "bt_amount", "draw_cnt", "card_cnt",
                    usage_mix("bt_amount", "draw_cnt", "card_cnt").alias("label"))


# ------------------------------------------------------------------------ joins
@register("join_left")
def q_join_left(spark, sf_dir):
    """Left outer equi-join on one key."""
    r = Roles(spark, sf_dir)
    return r.accounts.select("id", "product_type").join(r.applications, "id", "left")


@register("join_left_on_right_pred")
def q_join_left_on_right_pred(spark, sf_dir):
    """Left join with a right-side predicate in ON (unmatched rows kept)."""
    r = Roles(spark, sf_dir)
    e = r.enrolments.filter(F.col("status") == F.lit(C.enrolled))
    a = r.accounts.select("id", "status")
    return a.join(e.withColumnRenamed("status", "enrol_status"),
                  F.col("id") == F.col("account_id"), "left").select("id", "status", "enrol_status")


@register("join_left_on_left_pred")
def q_join_left_on_left_pred(spark, sf_dir):
    """Left join with a left-side predicate in ON (row kept, match suppressed)."""
    r = Roles(spark, sf_dir)
    a = r.accounts.select("id", "status", "program")
    app = r.app_attrs.select("app_id", "is_direct_mail")
    cond = ((F.col("id") == F.col("app_id")) & (F.col("status") == F.lit(C.opened))
            & (F.col("program") == F.lit(C.pcl_program)))
    return a.join(app, cond, "left").select("id", "status", "program", "is_direct_mail")


@register("join_inner_chain")
def q_join_inner_chain(spark, sf_dir):
    """Inner join chain line -> application -> offer -> decision."""
    r = Roles(spark, sf_dir)
    o = r.offers.select(F.col("id").alias("offer_id"), "decision_id")
    d = r.decisions.select(F.col("id").alias("decision_id"), "report_id")
    return (r.lines.select("line_id")
             .join(r.app_attrs.select(F.col("app_id").alias("line_id"), "offer_id"), "line_id")
             .join(o, "offer_id").join(d, "decision_id")
             .select("line_id", "offer_id", "decision_id", "report_id"))


@register("join_left_to_agg")
def q_join_left_to_agg(spark, sf_dir):
    """Left join to a relation aggregated on the join key."""
    r = Roles(spark, sf_dir)
    agg = r.positions.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_sublines"),
                                             F.sum("line_amount").cast("decimal(28,2)").alias("amount"))
    return r.front_end.select("line_id").join(agg, "line_id", "left")


@register("join_left_to_filtered")
def q_join_left_to_filtered(spark, sf_dir):
    """Left join to a filtered relation (filter before the join)."""
    r = Roles(spark, sf_dir)
    cyc = r.cycles.filter(F.col("mob") == 1).select(F.col("line_id").alias("cyc_line_id"), "mob", "income")
    return (r.front_end.select("line_id")
             .join(cyc, F.col("line_id") == F.col("cyc_line_id"), "left").drop("cyc_line_id"))


@register("first_touch_join")
def q_first_touch_join(spark, sf_dir):
    """Left join to the first touch per asset."""
    r = Roles(spark, sf_dir)
    ft = first_touch(r.touches, C)
    return (r.applications.select("id")
             .join(ft, F.col("id") == F.col("asset_id"), "left")
             .select("id", "updated_at", "event_id", "utm_source"))


def _issued_loans(r):
    return r.loans.filter(F.col("loan_status").isin(*C.issued_loan_statuses)).select("loan_id")


@register("join_unmatched_flag")
def q_join_unmatched_flag(spark, sf_dir):
    """Unmatched indicator after a left join (no issued prior loan)."""
    r = Roles(spark, sf_dir)
    d = r.decisions.select("id", "prior_loan_id")
    j = left_join(d, _issued_loans(r), "prior_loan_id", "loan_id", salt="id")
    return j.select("id", "prior_loan_id", flag(F.col("loan_id").isNull()).alias("no_prior_loan"))


@register("join_anti")
def q_join_anti(spark, sf_dir):
    """Decisions without an issued prior loan (left anti join)."""
    r = Roles(spark, sf_dir)
    d = r.decisions.select("id", "prior_loan_id")
    return left_anti_join(d, _issued_loans(r), "prior_loan_id", "loan_id", salt="id")


@register("join_left_where_right")
def q_join_left_where_right(spark, sf_dir):
    """Left join whose WHERE on the right side makes it an inner join."""
    r = Roles(spark, sf_dir)
    j = r.accounts.select("id", "status").join(r.loans, F.col("id") == F.col("loan_id"), "left")
    return j.filter(F.col("loan_status").isin(*C.issued_loan_statuses)).select("id", "status", "loan_status")


@register("range_self_join_counts")
def q_range_self_join_counts(spark, sf_dir):
    """Per-person range join (accounts dated before this + n months),
    computed by merging probes with the day histogram, without pairs."""
    return horizon_counts_merge(_hist(spark, sf_dir, materialize=True))


# ------------------------------------------------------------------ aggregates
@register("agg_conditional")
def q_agg_conditional(spark, sf_dir):
    """Conditional count, conditional sum, any-flag and conditional max per applicant."""
    pa = Roles(spark, sf_dir).prior_accounts
    pl = F.col("program").isin(*C.pl_programs)
    opened = F.col("servicing_status") == F.lit(C.servicing_open)
    return pa.groupBy("applicant_id").agg(
        F.sum(flag(pl & opened)).alias("open_pl"),
        F.sum(F.when(pl & opened, F.col("principal_balance")).otherwise(F.lit(0)))
         .cast("decimal(28,2)").alias("open_pl_balance"),
        F.max(flag(F.col("servicing_status") == F.lit(C.servicing_paidoff))).alias("any_paidoff"),
        F.max(F.when(F.col("program") == F.lit(C.pcl_program), F.col("contract_date"))).alias("last_pcl_date"))


@register("topk_rank_per_key")
def q_topk_rank_per_key(spark, sf_dir):
    """Last three bills per prior account, ties kept."""
    pay = Roles(spark, sf_dir).prior_payments
    return latest_k(pay, "prior_account_id", "due_date", 3)


# --------------------------------------------------------------- sort / limit
@register("sort_history")
def q_sort_history(spark, sf_dir):
    """O1: multi-key sort of the history (range-partitioned global sort)."""
    return _hist(spark, sf_dir).orderBy(F.col("person").asc_nulls_first(), "created", "id")


@register("sort_recent")
def q_sort_recent(spark, sf_dir):
    """O2: newest first."""
    return Roles(spark, sf_dir).touches.orderBy(F.col("updated_at").desc(), F.col("event_id").desc())


@register("limit_preview")
def q_limit_preview(spark, sf_dir):
    """O3: a preview of the first rows of the loaded PCL table under a total order (top-n, not a sort of
    all rows): the PCL counts are written as the load file, loaded, and previewed."""
    path = files.write_history_csv(_pipe(spark, sf_dir, materialize=True).firstpcl(), fresh_dir(spark, "preview"))
    good, _ = files.split_rejects(files.load_typed_csv(spark, path))
    return good.orderBy("id").limit(10)


# ------------------------------------------------------------------- functions
@register("fn_local_date")
def q_fn_local_date(spark, sf_dir):
    """local calendar dates of UTC instants (fixed offset and DST zone)."""
    t = Roles(spark, sf_dir).touches
    return t.select("event_id", "updated_at",
                    local_date("updated_at", ZONE_PST_FIXED).alias("pst_date"),
                    local_date("updated_at", ZONE_LOS_ANGELES).alias("la_date"))


@register("fn_year_month")
def q_fn_year_month(spark, sf_dir):
    """'yyyy-MM' of a date, and of its local date (a month start moves back)."""
    a = Roles(spark, sf_dir).accounts
    return a.select("id", year_month("created").alias("month"),
                    year_month(local_date("created", ZONE_LOS_ANGELES)).alias("local_month"))


@register("fn_datediff")
def q_fn_datediff(spark, sf_dir):
    """whole days as date boundaries crossed."""
    t = Roles(spark, sf_dir).touches
    return t.select("event_id", days_between("updated_at", F.lit("2024-01-01").cast("date")).alias("days"))


@register("fn_add_months")
def q_fn_add_months(spark, sf_dir):
    """calendar months added, clipped to the month end."""
    a = Roles(spark, sf_dir).accounts
    return a.select("id", "created", *[F.add_months("created", n).alias(f"plus_{n}m") for n in (1, 3, 6, 12)])


@register("fn_first_code")
def q_fn_first_code(spark, sf_dir):
    """first element of a bracketed quoted list."""
    pa = Roles(spark, sf_dir).prior_accounts
    return pa.select("id", "reward_codes", first_code("reward_codes").alias("first_code"))

