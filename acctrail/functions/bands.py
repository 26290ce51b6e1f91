"""Banding: an ordered CASE over one number, with the rules held as data.

The first rule that matches wins, so overlapping edges (365, 545 and 730
days) keep the label of the earlier rule, exactly as the source pipeline
does. Each rule is ``(label, low, low_inclusive, high, high_inclusive)``;
``None`` leaves that side open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import ColumnOrName, _c, classify

Rule = tuple[str, float | None, bool, float | None, bool]

# fixed values: score bands, fine variant (two labels share the prefix 'd:')
SCORE_FINE: list[Rule] = [
    ("a:[0%-3%)", 0.0, True, 0.03, False),
    ("b:[3%-5%)", 0.03, True, 0.05, False),
    ("c:[5%-7%)", 0.05, True, 0.07, False),
    ("d:[7%-8%)", 0.07, True, 0.08, False),
    ("d:[8%-9%)", 0.08, True, 0.09, False),
    ("e:[9%-10%)", 0.09, True, 0.10, False),
    ("f:[10%-13%)", 0.10, True, 0.13, False),
    ("g:[13%-15%)", 0.13, True, 0.15, False),
    ("h:[15%-17%)", 0.15, True, 0.17, False),
    ("i:[17%-20%)", 0.17, True, 0.2, False),
    ("j:[20%-23%)", 0.2, True, 0.23, False),
    ("k:[23%-27%)", 0.23, True, 0.27, False),
    ("t:[27%+)", 0.27, True, None, False),
]

# fixed values: score bands, coarse variant
SCORE_COARSE: list[Rule] = [
    ("a:[0%-3%)", 0.0, True, 0.03, False),
    ("b:[3%-5%)", 0.03, True, 0.05, False),
    ("c:[5%-7%)", 0.05, True, 0.07, False),
    ("d:[7%-9%)", 0.07, True, 0.09, False),
    ("e:[9%-11%)", 0.09, True, 0.11, False),
    ("f:[11%-13%)", 0.11, True, 0.13, False),
    ("g:[13%-15%)", 0.13, True, 0.15, False),
    ("h:[15%-17%)", 0.15, True, 0.17, False),
    ("i:[17%-20%)", 0.17, True, 0.2, False),
    ("j:[20%-23%)", 0.2, True, 0.23, False),
    ("k:[23%-27%)", 0.23, True, 0.27, False),
    ("t:[27%+)", 0.27, True, None, False),
]
SCORE_NULL_LABEL = "w:Null"

# fixed values: income bands; exactly 125000 matches no rule and falls to 'NA'
INCOME: list[Rule] = [
    ("<50K", None, False, 50000, False),
    ("50K-60K", 50000, True, 60000, False),
    ("60K-70K", 60000, True, 70000, False),
    ("70K-80K", 70000, True, 80000, False),
    ("80K-100K", 80000, True, 100000, False),
    ("100K-125K", 100000, True, 125000, False),
    ("125K+", 125000, False, None, False),
]

# fixed values: free-cash-flow bands
CASHFLOW: list[Rule] = [
    ("<2000", None, False, 2000, False),
    ("2K-4K", 2000, True, 4000, False),
    ("4K-6K", 4000, True, 6000, False),
    ("6K-8K", 6000, True, 8000, False),
    ("8K-12K", 8000, True, 12000, False),
    ("12K-15K", 12000, True, 15000, False),
    ("15K-20K", 15000, True, 20000, False),
    ("20K-25K", 20000, True, 25000, False),
    ("25K-30K", 25000, True, 30000, False),
    ("30K+", 30000, True, None, False),
]

# fixed values: days between two purchases; 365, 545 and 730 match two rules
DAYS_BETWEEN: list[Rule] = [
    ("<=30", None, False, 30, True),
    ("30-60", 30, False, 60, True),
    ("60-90", 60, False, 90, True),
    ("90-120", 90, False, 120, True),
    ("120-150", 120, False, 150, True),
    ("150-180", 150, False, 180, True),
    ("180-270", 180, False, 270, True),
    ("270-365", 270, False, 365, True),
    ("365-545", 365, True, 545, True),
    ("545-730", 545, True, 730, True),
    ("730+", 730, True, None, False),
]
NA = "NA"

# fixed values: draw usage labels
USAGE_BT, USAGE_NONE, USAGE_CARD, USAGE_ACH = "BT", "No draw", "Card Draw", "ACH Draw"
USAGE_CARD_SHARE = 0.50


def _rule_pred(c: Column, rule: Rule) -> Column:
    _, lo, lo_inc, hi, hi_inc = rule
    pred = None
    if lo is not None:
        pred = (c >= F.lit(lo)) if lo_inc else (c > F.lit(lo))
    if hi is not None:
        upper = (c <= F.lit(hi)) if hi_inc else (c < F.lit(hi))
        pred = upper if pred is None else (pred & upper)
    return pred if pred is not None else F.lit(True)


def band(col: ColumnOrName, rules: Sequence[Rule], *, null_label: str | None = None,
         negative_label: str | None = None, default: str | None = None) -> Column:
    """Label ``col`` by the first matching rule.

    ``null_label`` is returned for NULL; ``negative_label`` for values below
    zero (checked before the rules); ``default`` when nothing matches
    (``None`` leaves the row NULL, a CASE without ELSE).
    """
    c = _c(col)
    branches = []
    if null_label is not None:
        branches.append((c.isNull(), null_label))
    if negative_label is not None:
        branches.append((c < F.lit(0), negative_label))
    branches += [(_rule_pred(c, r), r[0]) for r in rules]
    return classify(branches, default)


def score_band_fine(col: ColumnOrName) -> Column:
    return band(col, SCORE_FINE, null_label=SCORE_NULL_LABEL)


def score_band_coarse(col: ColumnOrName) -> Column:
    return band(col, SCORE_COARSE, null_label=SCORE_NULL_LABEL)


def income_band(col: ColumnOrName) -> Column:
    return band(col, INCOME, null_label=NA, negative_label=NA, default=NA)


def cashflow_band(col: ColumnOrName) -> Column:
    return band(col, CASHFLOW, null_label=NA, negative_label=NA, default=NA)


def days_between_band(col: ColumnOrName) -> Column:
    return band(col, DAYS_BETWEEN, default=NA)


def usage_mix(bt_amount: ColumnOrName, draw_cnt: ColumnOrName, card_cnt: ColumnOrName) -> Column:
    """Draw usage label: a balance transfer wins, then the card share of draws."""
    bt, draws, cards = _c(bt_amount), _c(draw_cnt), _c(card_cnt)
    share = F.try_divide(cards.cast("double"), draws.cast("double"))
    return classify([
        (bt > F.lit(0), USAGE_BT),
        (draws.isNull() | (draws < F.lit(0)), NA),
        (draws == F.lit(0), USAGE_NONE),
        (share >= F.lit(USAGE_CARD_SHARE), USAGE_CARD),
        (share < F.lit(USAGE_CARD_SHARE), USAGE_ACH),
    ], NA)
