"""Q15-Q16: the front-end mart (driving lines + features + bands) and the final mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import ZONE_LOS_ANGELES
from ..functions import (cashflow_band, days_between, days_between_band, flag, income_band,
                         local_date, score_band_coarse, score_band_fine, usage_mix)
from ..operators.joins import keep_keys
from ..operators.unique import one_per_key

CYCLE_COLUMNS = ["mob", "contract_at", "income", "fcf_stated", "fcf_verified", "draw_cnt", "card_cnt",
                 "prior_reward_code", "enroll_reward_code", "funnel_reward_code"]
MART_MOB = 1
FEATURES = ["deposit", "transfers", "snapshot", "prior_accounts", "trade_lines", "autopay"]


def front_end_mart(front_end: DataFrame, cycles: DataFrame, scores: DataFrame, *,
                   deposit: DataFrame, transfers: DataFrame, snapshot: DataFrame,
                   prior_accounts: DataFrame, trade_lines: DataFrame, autopay: DataFrame,
                   mob: int = MART_MOB, only: DataFrame | None = None) -> DataFrame:
    """Q15: one row per driving line.

    Cycles and scores must have one row per line, or the run fails and names the table and the line; the feature
    tables are grouped by line already (autopay is checked where its feature is built).

    ``only`` (a one-column frame of line ids) restricts the driving table, cycles and scores before they are joined.

    All lookups are left joins on ``line_id``; the feature tables are grouped
    by ``line_id`` already, so their hash partitioning is reused by the joins.
    The key is the driving table's, so lines without a cycle row keep it (D16).
    """
    front_end, cycles = (keep_keys(t, "line_id", only) for t in (front_end, cycles))
    scores = keep_keys(scores, "loan_id", only)
    cyc = (one_per_key(cycles.filter(F.col("mob") == F.lit(mob)).select("line_id", *CYCLE_COLUMNS), "line_id", "cycles")
                 .select(F.col("line_id").alias("cyc_line_id"), *CYCLE_COLUMNS)
                 .withColumnRenamed("contract_at", "cyc_contract_at"))
    mob_df = front_end.select("line_id", F.col("score").alias("vr1_score"), "contract_at")
    sc = one_per_key(scores.select("loan_id", "score"), "loan_id", "scores").select(F.col("loan_id").alias("score_loan_id"), F.col("score").alias("vr1_pcl_score"))
    dp = snapshot.select("line_id", F.col("blacklist").alias("blacklist_dpl"))
    pa = prior_accounts.select("line_id", "priorpcl_contractdate")
    tu = trade_lines.drop("decision_id")
    bt = transfers.select("line_id", "bt_amount")
    dep = deposit.select("line_id", "cnt_deposit_products", "deposit_opened", "premier_savings_flag",
                         "premier_savings_na", "savings_flag", "first_deposit_open_date")
    ap = autopay.select("line_id", "ap_enrl_cancel_first_payment", "ap_enrl_cancel_60_days",
                        "ap_enrl_cancel_30_days", "ap_enrl_cancel_90_days", "ap_enrl_cancel_120_days",
                        "ap_enrl_cancel_180_days")

    j = (mob_df.join(dep, "line_id", "left")
               .join(bt, "line_id", "left")
               .join(cyc, F.col("line_id") == F.col("cyc_line_id"), "left")
               .join(sc, F.col("line_id") == F.col("score_loan_id"), "left")
               .join(dp, "line_id", "left")
               .join(pa, "line_id", "left")
               .join(tu, "line_id", "left")
               .join(ap, "line_id", "left"))

    gap = days_between(local_date("cyc_contract_at", ZONE_LOS_ANGELES), F.col("priorpcl_contractdate"))
    trade_cols = [c for c in trade_lines.columns if c not in ("decision_id", "line_id")]
    return j.select(
        "line_id",
        *[F.col("cyc_contract_at").alias("contract_at") if c == "contract_at" else F.col(c)
          for c in CYCLE_COLUMNS],
        F.col("vr1_pcl_score").alias("vr1_pcl_score_post_submit"),
        score_band_fine("vr1_pcl_score").alias("vr1_band_pcl_post_submit"),
        score_band_coarse("vr1_score").alias("vr1_band"),
        "blacklist_dpl",
        income_band("income").alias("stated_annual_income_cap400k_band1"),
        cashflow_band("fcf_stated").alias("fcf_stated_band1"),
        cashflow_band("fcf_verified").alias("fcf_verified_band1"),
        days_between_band(gap).alias("diff_between_pcl"),
        flag(F.col("prior_reward_code") == F.col("enroll_reward_code"))
         .alias("same_reward_secondpcl_masterline_enrll"),
        flag(F.col("prior_reward_code") == F.col("funnel_reward_code"))
         .alias("same_reward_secondpcl_funnel_locked"),
        *trade_cols,
        flag(F.col("sc_orig") > 0).alias("sc_orig_fl"),
        "bt_amount",
        flag(F.col("bt_amount") > 0).alias("bt_flag"),
        usage_mix("bt_amount", "draw_cnt", "card_cnt").alias("draw_txn_flag"),
        "cnt_deposit_products", "deposit_opened", "premier_savings_flag", "premier_savings_na",
        "savings_flag", "first_deposit_open_date",
        flag(F.col("first_deposit_open_date") < F.col("contract_at")).alias("deposit_before_pcl_flag"),
        "ap_enrl_cancel_first_payment", "ap_enrl_cancel_60_days", "ap_enrl_cancel_30_days",
        "ap_enrl_cancel_90_days", "ap_enrl_cancel_120_days", "ap_enrl_cancel_180_days")


def final_mart(repeats: DataFrame, front: DataFrame, limit: int | None = None) -> DataFrame:
    """Q16: repeat purchases left-joined to the front-end mart on the account id.

    ``limit`` exists for previews only (the source's leftover TOP 1); the
    default keeps every row.
    """
    r = repeats.select("person", "id", "created_at", "product_type",
                       F.col("channel").alias("pcl_channel"), "previous_product", "prev_channel",
                       "days_diff_twopcl")
    out = r.join(front, F.col("id") == F.col("line_id"), "left")
    return out.limit(limit) if limit is not None else out
