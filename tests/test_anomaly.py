import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arealis.functions.dtw import dtw_arrow, dtw_column, register_dtw
from arealis.operators import anomaly
from arealis.registry import AREA_KEYS


def warp(x, y):
    """Textbook recurrence, filled cell by cell."""
    best = {(-1, -1): 0.0}
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            best[i, j] = abs(a - b) + min(best.get(p, math.inf) for p in ((i - 1, j), (i, j - 1), (i - 1, j - 1)))
    return best[len(x) - 1, len(y) - 1]


def distances(spark, pairs):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "i int, x array<double>, y array<double>")
    out = df.select("i", dtw_column("x", "y").alias("c"), dtw_arrow()("x", "y").alias("a")).orderBy("i").collect()
    return [(r.c, r.a) for r in out]


def test_dtw_examples(spark):
    assert distances(spark, [([1.0, 2.0, 3.0, 4.0], [1.0, 1.0, 2.0, 5.0])]) == [(2.0, 2.0)]


def test_dtw_equals_recurrence(spark):
    rnd = random.Random(1)
    pairs = [
        ([rnd.uniform(-5, 5) for _ in range(rnd.choice([1, 3, 12]))], [rnd.uniform(-5, 5) for _ in range(rnd.choice([1, 4, 12]))])
        for _ in range(300)
    ]
    for (x, y), (c, a) in zip(pairs, distances(spark, pairs)):
        assert c == a == warp(x, y)


def test_dtw_needs_complete_input(spark):
    pairs = [([1.0, None], [1.0, 2.0]), ([], [1.0]), (None, [1.0]), ([1.0], [None])]
    assert distances(spark, pairs) == [(None, None)] * 4


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(-50, 50), min_size=24, max_size=24), min_size=1, max_size=30))
def test_dtw_properties(spark, rows):
    vectors = [([float(v) for v in r[:12]], [float(v) for v in r[12:]]) for r in rows]
    forth = distances(spark, vectors)
    back = distances(spark, [(y, x) for x, y in vectors])
    same = distances(spark, [(x, x) for x, _ in vectors])
    for (x, y), (d, _), (e, _), (z, _) in zip(vectors, forth, back, same):
        assert d == e and z == 0 and d <= sum(abs(a - b) for a, b in zip(x, y))


def test_dtw_from_sql(spark):
    register_dtw(spark)
    assert spark.sql("SELECT dtw_distance(array(1d, 2d), array(1d, 3d)) AS d").first().d == 1.0


def panel(spark, years, areas=(("p", "d", "s"),), value=lambda area, y, m: float(y * m % 7)):
    rows = [(*a, y, m, value(a, y, m)) for a in areas for y in years for m in range(1, 13)]
    return spark.createDataFrame(rows, "province string, district string, subdistrict string, year int, month int, NDVI double")


def test_trimmed_mean_of_squares(spark):
    df = panel(spark, range(2000, 2012), value=lambda a, y, m: float((y - 2000) ** 2))
    assert {r.NDVI for r in anomaly.trimmed_baseline(df, ["NDVI"]).collect()} == {38.5}


@pytest.mark.parametrize("n, cut", [(9, 0), (10, 1), (19, 1), (20, 2)])
def test_trim_counts(spark, n, cut):
    values = [float(v * v) for v in range(n)]
    df = panel(spark, range(2000, 2000 + n), value=lambda a, y, m: values[y - 2000])
    expected = np.mean(values[cut : n - cut])
    assert anomaly.trimmed_baseline(df, ["NDVI"]).first().NDVI == pytest.approx(expected, rel=1e-14)


def test_baseline_skips_nulls(spark):
    df = panel(spark, [2000, 2001], value=lambda a, y, m: None if m == 5 or y == 2000 else float(m))
    got = {r.month: r.NDVI for r in anomaly.trimmed_baseline(df, ["NDVI"]).collect()}
    assert got[5] is None and got[6] == 6.0


def test_incomplete_or_repeated_months_give_null(spark):
    df = panel(spark, [2000, 2001, 2002])
    short = df.where("NOT (year = 2000 AND month = 3)")
    twice = short.union(df.where("year = 2000 AND month = 4"))
    for arrow in (True, False):
        for changed in (short, twice):
            got = {r.year: r.dtw_ndvi for r in anomaly.dtw_area_years(changed, ["NDVI"], arrow=arrow).collect()}
            assert got[2000] is None and got[2001] is not None


def distance_frame(spark, values):
    rows = [("p", "d", "s", 2000 + i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "province string, district string, subdistrict string, year int, dtw_ndvi double")


def scored(spark, values):
    df = anomaly.z_flags(anomaly.z_scores(anomaly.local_stats(distance_frame(spark, values), ["NDVI"]), ["NDVI"]), ["NDVI"])
    return anomaly.local_flags(df, ["NDVI"]).orderBy("year").collect()


def test_one_year_has_no_deviation(spark):
    row = scored(spark, [1.0])[0]
    assert row.dtw_ndvi_local_std is None and row.dtw_ndvi_z is None
    assert row.dtw_ndvi_z_flag == 0 and row.dtw_ndvi_flag == 0


def test_equal_distances_have_no_score(spark):
    rows = scored(spark, [0.1] * 7)
    assert {r.dtw_ndvi_z for r in rows} == {None} and {r.dtw_ndvi_z_flag for r in rows} == {0}


def test_outlier_is_flagged(spark):
    rows = scored(spark, [1.0] * 5 + [None] + [9.0])
    assert [r.dtw_ndvi_z_flag for r in rows] == [0] * 6 + [1]
    assert [r.dtw_ndvi_flag for r in rows] == [0] * 6 + [1]
    assert rows[5].dtw_ndvi_z is None


def test_statistics_leave_the_province_out(spark):
    df = spark.createDataFrame(
        [("p", "d", "s", 2000, 1.0), ("q", "d", "s", 2000, 3.0)],
        "province string, district string, subdistrict string, year int, dtw_ndvi double",
    )
    assert {r.dtw_ndvi_local_mean for r in anomaly.local_stats(df, ["NDVI"]).collect()} == {2.0}
    by_area = anomaly.local_stats(df, ["NDVI"], AREA_KEYS).collect()
    assert {r.dtw_ndvi_local_mean for r in by_area} == {1.0, 3.0}


def test_composite_index(spark):
    df = spark.createDataFrame(
        [(1.0, 3.0, 0, 1), (None, 2.5, 0, 1), (None, None, 0, 0)],
        "dtw_ndvi_z double, dtw_lst_z double, dtw_ndvi_z_flag int, dtw_lst_z_flag int",
    )
    rows = anomaly.composite_index(df, ["NDVI", "LST"]).select("anomaly_index", "anomaly_flags").collect()
    assert [tuple(r) for r in rows] == [(2.0, 1), (2.5, 1), (None, 0)]


def test_table_columns(spark):
    df = panel(spark, range(2000, 2004), areas=[("p", "d", "s"), ("p", "d", "t")])
    table = anomaly.anomaly_table(df, ["NDVI"])
    assert table.columns == [
        *AREA_KEYS, "year", *[f"baseline_ndvi_m{m:02d}" for m in range(1, 13)], "dtw_ndvi", "dtw_ndvi_z", "dtw_ndvi_z_flag",
    ]
    kept = anomaly.anomaly_table(df, ["NDVI"], keep_stats=True)
    assert {"dtw_ndvi_local_mean", "dtw_ndvi_local_std", "dtw_ndvi_local_threshold", "dtw_ndvi_flag"} <= set(kept.columns)


def test_scoring_needs_one_shuffle_per_grouping(spark, tmp_path):
    panel(spark, [2000, 2001]).write.parquet(str(tmp_path / "p"))
    df = anomaly.dtw_area_years(spark.read.parquet(str(tmp_path / "p")), ["NDVI"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # by area and year, then by area


@pytest.mark.parametrize("arrow, shuffles", [(False, 1), (True, 2)])  # Spark loses sight of the partitioning behind Arrow
def test_scoring_shuffles_the_panel_once(spark, tmp_path, arrow, shuffles):
    panel(spark, range(2000, 2004), [("p", "d", f"s{i}") for i in range(4)]).write.parquet(str(tmp_path / "panel"))
    table = anomaly.anomaly_table(spark.read.parquet(str(tmp_path / "panel")), ["NDVI"], arrow=arrow)
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == shuffles


def test_small_units_have_scores(spark):
    rows = scored(spark, [1e-10, 2e-10, 9e-10])
    assert [r.dtw_ndvi_z for r in rows] == pytest.approx([r.dtw_ndvi_z for r in scored(spark, [1.0, 2.0, 9.0])])
