"""Numeric parsing and rounding expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from agroclim.constants import MJ_PER_KWH

# Thousands separators met in French-formatted numbers: no-break space,
# narrow no-break space, plain space.
_GROUP_SPACES = "[ \\u00a0\\u202f]"
# Fixed value: an agricultural campaign, two years with a slash.
_CAMPAIGN_YEAR = r"(?U)^\s*(\d{4})\s*/\s*\d{4}\s*$"
# A number as written in the sources; a type suffix such as 12d is no number.
_NUMBER = r"(?i)^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?$"
_OUTER_SPACES = r"(?U)^\s+|\s+$"
# pandas reads these tokens as missing before any parsing sees them.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def strip_spaces(col: Column) -> Column:
    """Without white space (any of Unicode's) at both ends."""
    return F.regexp_replace(col, _OUTER_SPACES, "")


def na_to_null(col: Column) -> Column:
    """Missing-value tokens (exact match, as a CSV reader sees them) to null."""
    return F.when(~col.isin(*NA_TOKENS), col)


def decimal_text(col: Column) -> Column:
    """Normalise '1 234,56' / '1.234,56' / '1234.56' to '1234.56' text.

    Spaces (incl. U+00A0, U+202F) are dropped. With both ',' and '.', '.' is the
    thousands mark; with only ',', it is the decimal mark. Blank gives null.
    """
    text = F.regexp_replace(strip_spaces(col), _GROUP_SPACES, "")
    both = text.contains(",") & text.contains(".")
    text = F.when(both, F.translate(F.regexp_replace(text, r"\.", ""), ",", ".")).otherwise(
        F.translate(text, ",", ".")
    )
    return F.when(text != "", text)


def parse_decimal(col: Column) -> Column:
    """Text number to DOUBLE. Junk raises under ANSI (a bad number is an error,
    not a silent null); blank and null give null."""
    text = decimal_text(col)
    return F.when(text.rlike(_NUMBER), text).otherwise(F.concat(text, F.lit("?"))).cast("double")


def try_parse_decimal(col: Column) -> Column:
    """Like ``parse_decimal`` but junk gives null (used to report rejects)."""
    text = decimal_text(col)
    return F.when(text.rlike(_NUMBER), text).try_cast("double")


def parse_year(col: Column) -> Column:
    """'2010/2011' -> 2010; '2010' / ' 2010.0 ' -> 2010; blank or junk -> null.

    Non-campaign text goes through DOUBLE and is truncated toward zero; a year beyond
    the INT column raises under ANSI.
    """
    text = strip_spaces(col)
    campaign = F.regexp_extract(col, _CAMPAIGN_YEAR, 1)
    return (
        F.when(campaign != "", campaign.cast("int"))
        .when(text.rlike(_NUMBER), text.cast("double").cast("int"))
    )


def mj_to_kwh(col: Column) -> Column:
    """MJ/m2 to kWh/m2, 3 decimals (half away from zero)."""
    return F.round(col / F.lit(Decimal(str(MJ_PER_KWH))), 3)


def round_half_up(col: Column, digits: int) -> Column:
    """Round a DOUBLE the same way in every engine: through DECIMAL(18, 9) first,
    so binary noise cannot move a decimal tie."""
    return F.round(col.cast("decimal(18,9)"), digits)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (no ANSI divide-by-zero error)."""
    return num / F.when(den != 0, den)


def clamp01(col: Column) -> Column:
    """least(greatest(x, 0), 1); like SQL, null inputs are skipped (null -> 0)."""
    return F.least(F.greatest(col, F.lit(0)), F.lit(1))
