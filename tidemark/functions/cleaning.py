"""Cleaning expressions used by the staging models."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# Country -> region lookup used to fill a missing region; any other country
# gets UNKNOWN_REGION.
COUNTRY_REGION = {
    "United States": "AMER",
    "Canada": "AMER",
    "Australia": "APAC",
    "Philippines": "APAC",
    "Germany": "EU",
    "France": "EU",
    "United Kingdom": "EU",
    "Netherlands": "EU",
    "Spain": "EU",
    "Brazil": "LATAM",
}
UNKNOWN_REGION = "Unknown"
# Raw discount-code spellings that mean "no code" (compared before trimming).
NO_DISCOUNT_CODES = ("N/A", "n/a", "")
# Category that marks an add-on product (compared after trimming).
ADDON_CATEGORY = "Add-on"
# ---------------------------------------------------------------------------


# Each rule is written once as SQL text over a column name (or expression), so a
# whole staging projection is one ``selectExpr`` call; the Column wrappers below
# give the same rules to DataFrame-API callers.

def _ident(c: str) -> str:
    """A bare column name quoted for SQL; anything else is taken as an expression."""
    return f"`{c}`" if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", c) else c


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def blank_to_null_sql(c: str) -> str:
    """Trimmed text, with an empty result turned into null."""
    return f"nullif(trim({_ident(c)}), '')"


def typed_sql(c: str, data_type: str, lenient: bool = False) -> str:
    """Cast of raw text: blank becomes null, anything unparsable fails, or with
    ``lenient`` becomes null.

    ANSI casts raise on bad input, like the warehouse's cast does; blank cells
    are null first because non-CSV sources can carry ''.
    """
    return f"{'TRY_CAST' if lenient else 'CAST'}({blank_to_null_sql(c)} AS {data_type})"


def unparsable_sql(c: str, data_type: str) -> str:
    """Whether a lenient cast would lose a cell's text."""
    return f"({blank_to_null_sql(c)} IS NOT NULL AND {typed_sql(c, data_type, True)} IS NULL)"


def parse_flag_sql(c: str) -> str:
    """'true'/'false' in any case and padding; everything else is false."""
    return f"coalesce(lower(trim({_ident(c)})) = 'true', false)"


def region_of_sql(country: str) -> str:
    """Look a country up in COUNTRY_REGION, UNKNOWN_REGION if absent (one
    map-literal lookup, folded to a constant map by the optimizer)."""
    pairs = ", ".join(f"{_sql_text(k)}, {_sql_text(v)}" for k, v in COUNTRY_REGION.items())
    return f"coalesce(try_element_at(map({pairs}), {_ident(country)}), {_sql_text(UNKNOWN_REGION)})"


def fill_region_sql(country: str, region: str, trim_values: bool) -> str:
    """Keep a present region, derive a missing (null or blank) one from country.

    Events keep country and region untrimmed; customers trim both
    (``trim_values=True``).
    """
    country, region = _ident(country), _ident(region)
    key = f"trim({country})" if trim_values else country
    kept = f"trim({region})" if trim_values else region
    return (f"CASE WHEN {region} IS NULL OR trim({region}) = '' THEN {region_of_sql(key)} "
            f"ELSE {kept} END")


def clean_discount_code_sql(c: str) -> str:
    """'N/A', 'n/a' and '' (exact, before trimming) become null, others trimmed."""
    c = _ident(c)
    codes = ", ".join(_sql_text(v) for v in NO_DISCOUNT_CODES)
    return f"CASE WHEN {c} IN ({codes}) THEN CAST(NULL AS string) ELSE trim({c}) END"


def date_parts_sql(ts: str) -> dict[str, str]:
    """Month label 'YYYY-MM' plus integer year, month and quarter."""
    ts = _ident(ts)
    return {
        "order_month": f"date_format({ts}, 'yyyy-MM')",
        "order_year": f"CAST(year({ts}) AS int)",
        "order_month_num": f"CAST(month({ts}) AS int)",
        "order_quarter": f"CAST(quarter({ts}) AS int)",
    }


def blank_to_null(c: str) -> Column:
    return F.expr(blank_to_null_sql(c))


def typed(c: str, data_type: str) -> Column:
    return F.expr(typed_sql(c, data_type))


def parse_flag(c: str) -> Column:
    return F.expr(parse_flag_sql(c))


def region_of(country: str) -> Column:
    return F.expr(region_of_sql(country))


def fill_region(country: str, region: str, trim_values: bool) -> Column:
    return F.expr(fill_region_sql(country, region, trim_values))


def clean_discount_code(c: str) -> Column:
    return F.expr(clean_discount_code_sql(c))


def date_parts(ts: str) -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in date_parts_sql(ts).items()}
