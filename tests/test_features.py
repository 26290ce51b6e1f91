"""Feature stages on small in-memory fixtures (FIXTURES section 4)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrail.codes import ChannelRules
from acctrail.plans.channels import channel_classify
from acctrail.plans.features import feature_deposit, feature_payment_history, last_bills_good_count

D = dt.date
S, L, DT, TS = T.StringType(), T.LongType(), T.DateType(), T.TimestampNTZType()


def schema(*cols):
    return T.StructType([T.StructField(n, t) for n, t in cols])


PEOPLE = schema(("id", L), ("created_at", TS), ("product_type", S), ("status", S), ("program", S),
                ("program_code", S), ("lap_id", L), ("borrower_id", L), ("initiator", S), ("person", S))


def person_row(i, person, product="PCL", status="OPENED", program="PCL", code="DEP_CK_01", initiator="CUSTOMER",
               created=dt.datetime(2020, 1, 1)):
    return (i, created, product, status, program, code, i, i, initiator, person)


def test_payment_history_ranks_ties_and_tolerance(spark):
    pays = spark.createDataFrame([
        # account 1: due dates 10, 9, 9, 8 -> ranks 1, 2, 2, 4: bills <= 3 are the first three rows
        (1, D(2020, 1, 10), D(2020, 1, 25)),   # exactly 15 days late -> good
        (1, D(2020, 1, 9), D(2020, 1, 25)),    # 16 days -> not good
        (1, D(2020, 1, 9), D(2020, 1, 9)),     # good
        (1, D(2020, 1, 8), D(2020, 1, 8)),     # rank 4 -> left out
        # account 2: a NULL due date ranks first (descending, NULLs first) and is never good
        (2, None, D(2020, 1, 1)), (2, D(2020, 1, 5), D(2020, 1, 5)), (2, D(2020, 1, 4), D(2020, 1, 4)),
        (2, D(2020, 1, 3), D(2020, 1, 3)),
    ], schema(("prior_account_id", L), ("due_date", DT), ("paid_date", DT)))
    good = {r["prior_account_id"]: r["good3pmt_count"] for r in last_bills_good_count(pays).collect()}
    assert good == {1: 2, 2: 2}

    priors = spark.createDataFrame([
        (1, 100, "CORE", "OPEN", 1), (2, 100, "CORE", "OPEN", 2), (3, 100, "CORE", "OPEN", 3),   # 3: no bills
        (4, 200, "CORE", "CLOSED_PAIDOFF", 4), (5, 300, "OTHER", "OPEN", 5),
    ], schema(("id", L), ("applicant_id", L), ("program", S), ("servicing_status", S), ("prior_lir_id", L)))
    people = spark.createDataFrame([person_row(10, "a"), person_row(20, "b"), person_row(30, "c"),
                                    person_row(40, "d", status="ISSUED")], PEOPLE)
    chain = spark.createDataFrame([(10, 100), (20, 200), (30, 300), (40, 100)],
                                  schema(("app_id", L), ("applicant_id", L)))
    out = {r["line_id"]: r["good3pmt_count"] for r in
           feature_payment_history(people, chain, priors, pays).collect()}
    # line 10: min(2, 2, 0) = 0; lines 20 and 30 have no open personal loan; 40 is not opened
    assert out == {10: 0}


def test_deposit_feature_null_person_and_flags(spark):
    people = spark.createDataFrame([
        person_row(1, "p"), person_row(2, None),
        person_row(3, "p", product="DEP", program="OTHER", code="DEP_SV_01", created=dt.datetime(2019, 5, 1)),
        person_row(4, "p", product="DEP", program="OTHER", code="DEP_CK_01", created=dt.datetime(2018, 5, 1)),
        person_row(5, None, product="DEP", program="OTHER"),
    ], PEOPLE)
    dap = spark.createDataFrame([(3, "SAVINGS"), (4, "CHECKING")], schema(("account_id", L), ("account_type", S)))
    got = {r["line_id"]: r.asDict() for r in feature_deposit(people, dap).collect()}
    assert got[1]["cnt_deposit_products"] == 2 and got[1]["premier_savings_flag"] == 1
    assert got[1]["premier_savings_na"] == 1 and got[1]["savings_flag"] == 1
    assert got[1]["first_deposit_open_date"] == dt.datetime(2018, 5, 1)
    assert got[2]["cnt_deposit_products"] == 0 and got[2]["deposit_opened"] == 0
    assert got[2]["first_deposit_open_date"] is None


def test_channel_branches(spark):
    rules = ChannelRules()
    ids = list(range(1, 11))
    people = spark.createDataFrame([person_row(i, f"p{i}", initiator="INTERNAL" if i == 9 else "CUSTOMER")
                                    for i in ids], PEOPLE).withColumn(
        "fico_score", F.when(F.col("id") != 3, F.col("id").cast("int") + 600))
    app = spark.createDataFrame([
        # app_id, direct_mail, utm, good_source, referrer, source_system, program, offer_id
        (1, "true", "partner_a", "false", None, None, "PCL", None),   # DM wins over partner (two branches)
        (2, "false", "partner_a", "true", None, None, "PCL", None),   # partner + enrolled
        (3, "false", "partner_a", "true", None, None, "PCL", None),   # partner
        (4, "false", "search", "true", None, None, "PCL", None),     # touch: existing campaign
        (5, "false", "x_ub1", "false", None, "WEB", "PCL", None),    # high risk, first group
        (6, "false", "search", "true", None, None, "PCL", None),     # touch: purchase label
        (7, "false", "", "false", None, None, "PCL", 70),            # issued prior loan: not high risk
        (8, "false", "search", "true", "XREF_BX", None, "PCL", None),  # high risk by referrer pattern
        (9, "false", "search", "true", None, None, "PCL", None),     # cross-sell initiator
    ], schema(("app_id", L), ("is_direct_mail", S), ("utm_source", S), ("good_source", S), ("api_referrer", S),
              ("source_system", S), ("program", S), ("offer_id", L)))
    chain = spark.createDataFrame([(i, 7 if i == 7 else None) for i in ids],
                                  schema(("app_id", L), ("prior_loan_id", L)))
    enrol = spark.createDataFrame([(2, "ENROLLED")], schema(("account_id", L), ("status", S)))
    touches = spark.createDataFrame([
        (1000, 4, dt.datetime(2020, 1, 1), "click", "app_create"),
        (1001, 4, dt.datetime(2020, 1, 2), "purchase", "app_create"),   # later touch: ignored
        (1002, 6, dt.datetime(2020, 1, 1), "purchase", "app_create"),
        (1003, 6, dt.datetime(2019, 1, 1), "view", "other"),            # not the tracked event
        (1004, 10, dt.datetime(2020, 1, 1), "error", "app_create"),     # excluded source
    ], schema(("event_id", L), ("asset_id", L), ("updated_at", TS), ("utm_source", S), ("event", S)))
    loans = spark.createDataFrame([(7, "ISSUED")], schema(("loan_id", L), ("loan_status", S)))
    base = spark.createDataFrame([(i, D(2020, 3, 1)) for i in ids], schema(("id", L), ("created", DT)))
    rows = channel_classify(base, people, app, chain, enrol, touches, loans).collect()
    assert {r["id"]: r["fico_score"] for r in rows} == {i: None if i == 3 else 600 + i for i in ids}
    got = {r["id"]: (r["pcl_channel"], r["contract_month"]) for r in rows}
    assert {i: c for i, (c, _) in got.items()} == {
        1: rules.direct_mail_label, 2: rules.partner_rewards_label, 3: rules.partner_label,
        4: rules.existing_campaign_label, 5: rules.high_risk_label, 6: "RAS-PURCHASE",
        7: rules.default_label, 8: rules.high_risk_label, 9: rules.xsell_label, 10: rules.default_label}
    assert got[1][1] == "2020-02"  # the first of a month moves back in the local zone
