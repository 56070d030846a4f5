"""Cleaning rules equal a plain-Python statement of the same rules on random text."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions.cleaning import (
    COUNTRY_REGION, NO_DISCOUNT_CODES, UNKNOWN_REGION, clean_discount_code, fill_region, parse_flag,
)

pieces = st.sampled_from(["", " ", "  ", "true", "TRUE", "False", "N/A", "n/a", "x", "EU",
                          "Canada", "Japan", "United States", "WELCOME10"])
text = st.one_of(st.none(), st.lists(pieces, max_size=3).map("".join))


def _trim(v):
    return v.strip(" ")


def py_flag(v):
    return v is not None and _trim(v).lower() == "true"


def py_code(v):
    if v is None or v in NO_DISCOUNT_CODES:
        return None
    return _trim(v)


def py_region(country, region, trim_values):
    if region is None or _trim(region) == "":
        key = _trim(country) if (trim_values and country is not None) else country
        return COUNTRY_REGION.get(key, UNKNOWN_REGION)
    return _trim(region) if trim_values else region


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(text, text, text), min_size=1, max_size=30))
def test_rules_match_python(spark, rows):
    df = spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(rows)],
                               "id int, a string, b string, c string")
    got = df.select("id", parse_flag("a").alias("flag"), clean_discount_code("a").alias("code"),
                    fill_region("b", "c", False).alias("ev_region"),
                    fill_region("b", "c", True).alias("cu_region")).collect()
    for r in got:
        a, b, c = rows[r.id]
        assert r.flag == py_flag(a)
        assert r.code == py_code(a)
        assert r.ev_region == py_region(b, c, False)
        assert r.cu_region == py_region(b, c, True)
