"""Scalar functions: flags, ordered labelling, bands, dates, codes."""

from .bands import (band, cashflow_band, days_between_band, income_band, score_band_coarse,
                    score_band_fine, usage_mix)
from .exprs import (classify, days_between, first_code, flag, local_date, null_or_ne, ratio,
                    year_month)

__all__ = [
    "band", "cashflow_band", "classify", "days_between", "days_between_band", "first_code",
    "flag", "income_band", "local_date", "null_or_ne", "ratio", "score_band_coarse",
    "score_band_fine", "usage_mix", "year_month",
]
