"""Distributed global rank equals SQL rank() on random data with ties and nulls."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions.ranking import with_global_rank, with_global_ranks


def _sql_rank(values, descending=True):
    present = [v for v in values if v is not None]
    out = []
    for v in values:
        if v is None:
            out.append(len(present) + 1)
        else:
            out.append(1 + sum(1 for w in present if (w > v if descending else w < v)))
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=40))
def test_rank_matches_sql_rank(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    for descending in (True, False):
        got = {r.id: r.rk for r in
               with_global_rank(df.repartition(5), "v", "rk", descending).collect()}
        assert [got[i] for i in range(len(values))] == _sql_rank(values, descending)


def test_rank_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = spark.range(0, 500).selectExpr("id", "cast(id % 37 as int) AS v")
        got = {r.id: r.rk for r in with_global_rank(df, "v", "rk").collect()}
        vals = [i % 37 for i in range(500)]
        want = _sql_rank(vals)
        assert [got[i] for i in range(500)] == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_several_ranks(spark):
    rows = [(i, (i * 7) % 5, None if i % 4 == 0 else i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    want_a = _sql_rank([r[1] for r in rows])
    want_b = _sql_rank([r[2] for r in rows])
    got = {r.id: (r.ra, r.rb) for r in
           with_global_ranks(df, [("a", "ra"), ("b", "rb")]).collect()}
    assert [got[i] for i in range(30)] == list(zip(want_a, want_b))


def test_positions_number_the_rows_in_order(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.ranking import with_positions
    rows = [(i, None if i % 7 == 0 else i % 5, f"n{i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v int, n string").repartition(6)
    got = with_positions(df, [F.desc_nulls_first("v"), F.asc("n")]).collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[2], r[0]))
    assert sorted((r.position, r.id) for r in got) == [(i + 1, r[0]) for i, r in enumerate(want)]


def test_ranks_of_several_types_and_one_common_value(spark):
    rows = [(i, "x" if i % 3 else f"s{i}", None if i == 5 else i % 2 / 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a string, b double")
    got = {r.id: (r.ra, r.rb) for r in
           with_global_ranks(df, [("a", "ra"), ("b", "rb")]).collect()}
    want = zip(_sql_rank([r[1] for r in rows]), _sql_rank([r[2] for r in rows]))
    assert [got[i] for i in range(60)] == list(want)
