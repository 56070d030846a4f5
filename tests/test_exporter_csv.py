"""CSV as Python's csv module writes it: shuffled headers, quotes, line feeds."""

import csv
import os

import pytest

from tidemark.schemas import RAW_SCHEMAS
from tidemark.sources.raw import read_raw

ODD = ['ends "q"', 'He said "hi", twice', "a, back\\", "  padded  ", "two\nlines", '"', "plain"]


def _write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def test_columns_by_name_and_odd_cells(spark, scratch):
    names = RAW_SCHEMAS["customers"].names
    header = list(reversed(names))
    rows = [[f"{text}|{c}" for c in header] for text in ODD]
    path = os.path.join(scratch, "customers.csv")
    _write(path, header, rows)
    got = read_raw(spark, "customers", path, options={"multiLine": True})
    assert got.columns == names
    want = sorted(tuple(dict(zip(header, r))[c] for c in names) for r in rows)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_wrong_header_raises(spark, scratch):
    names = RAW_SCHEMAS["customers"].names
    path = os.path.join(scratch, "customers.csv")
    _write(path, [*names[:-1], "joined"], [["x"] * len(names)])
    with pytest.raises(ValueError, match="joined"):
        read_raw(spark, "customers", path)
