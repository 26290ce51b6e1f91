"""Code values the pipeline matches on, gathered in one place.

Business codes are parameters: a deployment passes its own warehouse codes.
The defaults are neutral stand-ins used by the role views in
``acctrail.sources.roles``; bands and bureau codes are the source pipeline's
own values (see ``acctrail.functions.bands``).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Products:
    """Product-type codes counted per customer; ``tot`` is not a code."""

    pcl: str = "PCL"
    pl: str = "PL"
    dep: str = "DEP"
    hm: str = "HM"

    def items(self) -> list[tuple[str, str]]:
        return [("pcl", self.pcl), ("pl", self.pl), ("dep", self.dep), ("hm", self.hm)]


@dataclass(frozen=True)
class AccountCodes:
    opened: str = "OPENED"
    issued: str = "ISSUED"
    pcl_program: str = "PCL"
    # programs whose prior accounts are personal loans
    pl_programs: tuple[str, ...] = ("CORE", "PARTNER")
    deposit_product: str = "DEP"
    # fixed values: premier savings program codes of the source pipeline
    premier_savings_codes: tuple[str, ...] = ("DEP_SV_01", "DEP_SV_02", "DEP_SV_05")
    savings_types: tuple[str, ...] = ("SAVINGS",)
    # fixed values: prior-account application statuses of the source pipeline
    prior_open_statuses: tuple[str, ...] = ("Opened", "OPENED", "Ready to open", "READY_TO_OPEN")
    prior_issued_statuses: tuple[str, ...] = ("Issued", "ISSUED", "Reissued", "REISSUED")
    servicing_open: str = "OPEN"
    servicing_paidoff: str = "CLOSED_PAIDOFF"
    servicing_chargeoff: str = "CLOSED_CHARGEOFF"
    # fixed values: loan statuses that count as an issued prior loan
    issued_loan_statuses: tuple[str, ...] = ("ISSUED", "REISSUED")
    enrolled: str = "ENROLLED"
    balance_transfer: str = "BALANCE_TRANSFER"
    draw_onboarded: str = "ONBOARDED"
    autopay_active: str = "ACTIVE"
    touch_event: str = "app_create"


@dataclass(frozen=True)
class ChannelRules:
    """Ordered channel classification; the first matching branch wins."""

    direct_mail_label: str = "DM"
    partner_source: str = "partner_a"
    partner_rewards_label: str = "Partner Rewards"
    partner_label: str = "Partner"
    touch_prefix: str = "RAS-"
    touch_excluded_sources: tuple[str, ...] = ("error", "error_click")
    existing_campaign_codes: tuple[str, ...] = ("RAS-CLICK", "RAS-SIGNUP")
    existing_campaign_label: str = "ExistingPL campaign"
    # pattern with the one-character wildcard: '_' must precede "ub"
    high_risk_source_like: str = "%_ub%"
    high_risk_referrers: tuple[str, ...] = ("REF_A",)
    high_risk_referrer_like: str = "%REF_B%"
    high_risk_referrer_exact: str = "REF_CARD"
    phone_source_system: str = "PHONE"
    high_risk_label: str = "High Risk Channel"
    # touch codes that each get their own label, in branch order
    touch_code_labels: tuple[tuple[str, str], ...] = field(default_factory=lambda: (
        ("RAS-PURCHASE", "RAS-PURCHASE"),
        ("RAS-VIEW", "RAS-VIEW"),
        ("RAS-ERROR", "RAS-ERROR"),
    ))
    xsell_initiator: str = "INTERNAL"
    xsell_label: str = "XSell"
    default_label: str = "Others"


# fixed values: time zones of the source pipeline. Its 'PST' is a zone
# abbreviation, which the warehouse applies as a fixed UTC-8 offset (no DST);
# the named zone follows daylight saving time.
ZONE_PST_FIXED = "-08:00"
ZONE_LOS_ANGELES = "America/Los_Angeles"

# fixed values: the history horizons in calendar months and column suffixes
HORIZON_MONTHS = (3, 6, 12)
COUNT_CATEGORIES = ("tot", "pcl", "pl", "dep", "hm")
COUNT_SUFFIXES = ("orig", "3month", "6month", "12month", "today")


def count_col(category: str, suffix: str) -> str:
    return f"cnt_{category}_post_accts1_{suffix}"


def count_cols(suffixes=COUNT_SUFFIXES) -> list[str]:
    return [count_col(c, s) for s in suffixes for c in COUNT_CATEGORIES]
