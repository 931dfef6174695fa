"""Column names, month arithmetic and other scalar expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Truncated column names and their full form.
COLUMN_REPAIRS = {"subdistric": "subdistrict"}

# Rounding adds this before cutting digits off: a half, moved away from values that end in 5.
TIE_POINT = 0.5003


def normalize_columns(df: DataFrame, lower: bool = True) -> DataFrame:
    """Trim column names, turn blanks into underscores, repair truncated names."""

    def tidy(name: str) -> str:
        name = re.sub(" ", "_", name.strip())
        fixed = COLUMN_REPAIRS.get(name.lower())
        if fixed:
            name = fixed if name[0].islower() else fixed.capitalize()
        return name.lower() if lower else name

    return df.toDF(*[tidy(c) for c in df.columns])


def upper_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Upper-case key values; null keys stay null."""
    return df.withColumns({k: F.upper(F.col(k).cast("string")) for k in keys})


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Raise before planning when a required column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that are absent, in the order asked for."""
    return [c for c in required if c not in df.columns]


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL so that aggregates and comparisons skip it."""
    kinds = dict(df.dtypes)
    names = [c for c in (columns or df.columns) if kinds[c] in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def month_start(year: Column | str = "year", month: Column | str = "month") -> Column:
    """First day of a month."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def month_number(year: Column | str = "year", month: Column | str = "month") -> Column:
    """Months counted from year 0: consecutive months differ by one."""
    return (_col(year) * 12 + _col(month) - 1).cast("int")


def year_of(number: Column) -> Column:
    return F.floor(number / 12).cast("int")


def month_of(number: Column) -> Column:
    return (F.pmod(number, F.lit(12)) + 1).cast("int")


def parse_month(text: Column | str) -> Column:
    """``yyyy-MM`` or a full date -> first day of that month; anything else -> null."""
    text = F.trim(_col(text))
    full = F.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)
    return F.trunc(F.try_to_date(full, "yyyy-MM-dd"), "month")


def month_label(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def month_title(day: Column | str) -> Column:
    return F.date_format(_col(day), "MMM yyyy")


def output_name(variable: Column | str, year: Column | str, month: Column | str) -> Column:
    """File stem of one variable and month."""
    return F.format_string("%s_%d_%02d", _col(variable), _col(year), _col(month))


def join_names(*names: Column | str) -> Column:
    return F.concat_ws(", ", *[_col(n) for n in names])


def settled(value: Column | str, digits: int = 6) -> Column:
    """Round half up to ``digits``, with the tie point moved off short decimals.

    Sums of doubles depend on the order of addition in the last bit. A value lying exactly on a rounding
    tie would then round either way; shifting the tie point makes the rounded value repeatable.
    """
    scale = float(10**digits)
    return F.floor(_col(value) * F.lit(scale) + F.lit(TIE_POINT)) / F.lit(scale)


def settle_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """``settled`` on every double column."""
    scale = f"{10**digits}D"
    return df.selectExpr(
        *[
            f"floor(`{name}` * {scale} + {TIE_POINT}D) / {scale} AS `{name}`" if kind == "double" else f"`{name}`"
            for name, kind in df.dtypes
        ]
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
