"""Q4: acquisition channel of each account (ordered classification over joins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import ZONE_LOS_ANGELES, AccountCodes, ChannelRules
from ..functions import classify, local_date, null_or_ne, year_month
from ..operators.firsts import first_per_key
from ..operators.joins import left_join

#: what the classification reads of an account besides its id and day
ACCOUNT_COLUMNS = ["status", "program", "fico_score", "lap_id", "initiator"]


def first_touch(touches: DataFrame, codes: AccountCodes = AccountCodes()) -> DataFrame:
    """Each asset's earliest touch of the tracked event (asset_id, updated_at, event_id, utm_source)."""
    t = touches.filter(F.col("event") == F.lit(codes.touch_event))
    return first_per_key(t, "asset_id", ["updated_at", "event_id"], ["utm_source"])


def decision_chain(app_attrs: DataFrame, offers: DataFrame, decisions: DataFrame) -> DataFrame:
    """application -> selected offer -> credit decision, built once and reused.

    Output: app_id, decision_id, prior_loan_id, applicant_id, report_id
    (left joins: an application without an offer keeps NULLs).
    """
    a = app_attrs.select("app_id", "offer_id")
    o = offers.select(F.col("id").alias("_o_id"), "decision_id")
    d = decisions.select(F.col("id").alias("_d_id"), "prior_loan_id", "applicant_id", "report_id")
    # applications without a selected offer (NULL keys) are spread, not piled up
    j = left_join(a, o, "offer_id", "_o_id", salt="app_id")
    j = left_join(j, d, "decision_id", "_d_id", salt="app_id")
    return j.select("app_id", "decision_id", "prior_loan_id", "applicant_id", "report_id")


def touch_code(src: Column, rules: ChannelRules) -> Column:
    """'<prefix><source>' for a kept touch source, else NULL (F9: NULL-propagating concat)."""
    keep = src.isNotNull() & ~src.isin(*rules.touch_excluded_sources)
    return F.when(keep, F.concat(F.lit(rules.touch_prefix), src))


def channel_label(rules: ChannelRules = ChannelRules(), codes: AccountCodes = AccountCodes()) -> Column:
    """The ordered channel CASE over the joined columns (first match wins)."""
    dm, utm = F.col("is_direct_mail"), F.col("utm_source")
    good, ref, srcsys = F.col("good_source"), F.col("api_referrer"), F.col("source_system")
    prog = F.col("app_program")
    code = F.upper(touch_code(F.col("touch_source"), rules))
    no_prior_loan = F.col("issued_prior_loan_id").isNull()
    not_phone = null_or_ne(srcsys, rules.phone_source_system)
    high_risk = (
        (utm.like(rules.high_risk_source_like) & (good == F.lit("false")) & (dm == F.lit("false"))
         & ref.isNull() & not_phone & (prog == F.lit(codes.pcl_program)) & no_prior_loan)
        | ref.isin(*rules.high_risk_referrers)
        | ((dm == F.lit("false")) & ref.isNull() & not_phone & (utm.isNull() | (utm == F.lit("")))
           & (good == F.lit("false")) & (prog == F.lit(codes.pcl_program)) & no_prior_loan)
        | (ref.like(rules.high_risk_referrer_like) | (ref == F.lit(rules.high_risk_referrer_exact)))
    )
    branches = [
        (dm == F.lit("true"), rules.direct_mail_label),
        ((utm == F.lit(rules.partner_source)) & (F.col("enrol_status") == F.lit(codes.enrolled)),
         rules.partner_rewards_label),
        (utm == F.lit(rules.partner_source), rules.partner_label),
        (code.isin(*rules.existing_campaign_codes), rules.existing_campaign_label),
        (high_risk, rules.high_risk_label),
        *[(code == F.lit(c), label) for c, label in rules.touch_code_labels],
        (F.col("initiator") == F.lit(rules.xsell_initiator), rules.xsell_label),
    ]
    return classify(branches, rules.default_label)


def channel_classify(base: DataFrame, people: DataFrame | None, app_attrs: DataFrame, chain: DataFrame,
                     enrolments: DataFrame, touches: DataFrame, loans: DataFrame, *,
                     rules: ChannelRules = ChannelRules(),
                     codes: AccountCodes = AccountCodes()) -> DataFrame:
    """Q4: ``base`` (rows keyed by account ``id`` with a DATE ``created``) plus
    the account's ``fico_score``, ``contract_month`` and ``pcl_channel``.

    ``people`` is :func:`acctrail.plans.history.resolve_people` and ``chain``
    is :func:`decision_chain`. Without ``people``, ``base`` carries ``ACCOUNT_COLUMNS`` of its
    accounts itself: nothing is looked up, and of these only ``fico_score`` comes out. Join shape: every lookup is a left join keyed
    by the account id, so the driving rows are shuffled once on ``id`` and
    each lookup side once; the offer -> decision -> prior-loan chain is
    resolved on the application side before it meets the accounts.
    """
    kept = [c for c in base.columns if people is not None or c not in ACCOUNT_COLUMNS]
    renamed = {"status": "lir_status", "program": "lir_program"}
    if people is None:
        j = base.withColumnsRenamed(renamed)
    else:
        j = base.join(people.select("id", *ACCOUNT_COLUMNS).withColumnsRenamed(renamed), "id", "left")
    issued = (loans.filter(F.col("loan_status").isin(*codes.issued_loan_statuses))
                   .select(F.col("loan_id").alias("issued_prior_loan_id")).distinct())
    app = (app_attrs.select("app_id", "is_direct_mail", "utm_source", "good_source", "api_referrer",
                            "source_system", F.col("program").alias("app_program"))
           .join(chain.select("app_id", "prior_loan_id"), "app_id", "left"))
    # most decisions carry no prior loan: NULL keys are spread, not piled up
    app = left_join(app, issued, "prior_loan_id", "issued_prior_loan_id", salt="app_id").drop("prior_loan_id")
    enrolled = (enrolments.filter(F.col("status") == F.lit(codes.enrolled))
                          .select(F.col("account_id").alias("enrol_id"),
                                  F.col("status").alias("enrol_status")).distinct())
    ras = first_touch(touches, codes).select(F.col("asset_id"), F.col("utm_source").alias("touch_source"))

    # The account-side predicate stays in the ON clause (row kept, match suppressed)
    j = j.join(app, (F.col("id") == F.col("app_id")) & (F.col("lir_status") == F.lit(codes.opened))
               & (F.col("lir_program") == F.lit(codes.pcl_program)), "left")
    j = j.join(enrolled, F.col("id") == F.col("enrol_id"), "left")
    # the application id equals the account id whenever it exists, so the touch
    # lookup stays keyed (and co-partitioned) on id; no application, no touch
    j = j.join(ras, (F.col("id") == F.col("asset_id")) & F.col("lap_id").isNotNull(), "left")
    return j.select(*kept, "fico_score",
                    year_month(local_date("created", ZONE_LOS_ANGELES)).alias("contract_month"),
                    channel_label(rules, codes).alias("pcl_channel"))
