"""The six derived loan features (row-local projections).

Input column names default to the dotted spelling of the loan data; pass
``names`` to map them onto other spellings (e.g. ``revol_util``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, validate_columns
from ..functions.numeric import clip

# The input columns, in the order they are reported missing.
REQUIRED_COLUMNS = ("revol.util", "inq.last.6mths", "installment", "log.annual.inc",
                    "days.with.cr.line", "dti")
ENGINEERED = ("credit_util_ratio", "annual_inquiry_rate", "debt_burden", "credit_history_years",
              "high_debt", "risk_score")


def validate_features_for_engineering(df: DataFrame, names: Mapping[str, str] | None = None
                                      ) -> tuple[bool, list[str]]:
    names = dict(names or {})
    return validate_columns(df, [names.get(k, k) for k in REQUIRED_COLUMNS])


def create_loan_features(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Append credit_util_ratio, annual_inquiry_rate, debt_burden,
    credit_history_years, high_debt and risk_score."""
    n = {k: (names or {}).get(k, k) for k in REQUIRED_COLUMNS}
    util, inq = c(n["revol.util"]), c(n["inq.last.6mths"])
    inst, linc = c(n["installment"]), c(n["log.annual.inc"])
    days, dti = c(n["days.with.cr.line"]), c(n["dti"])
    util_ratio = util / F.lit(100.0)
    years = days / F.lit(365.25)
    # a missing value compares False, as in pandas
    high = (F.coalesce(dti > F.lit(20), F.lit(False)) | F.coalesce(util > F.lit(80), F.lit(False))).cast("int")
    risk = (util_ratio * F.lit(0.3) + (inq / F.lit(10.0)) * F.lit(0.2) + (dti / F.lit(30.0)) * F.lit(0.3)
            + (F.lit(1.0) - clip(years / F.lit(20.0), 0.0, 1.0)) * F.lit(0.2))
    return df.select("*", util_ratio.alias("credit_util_ratio"), (inq * 2).alias("annual_inquiry_rate"),
                     (inst / F.exp(linc)).alias("debt_burden"), years.alias("credit_history_years"),
                     high.alias("high_debt"), risk.alias("risk_score"))
