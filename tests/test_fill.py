import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arealis.operators import fill
from arealis.registry import AREA_KEYS

SCHEMA = "province string, district string, subdistrict string, year int, month int, v double"


def series(spark, values, area=("p", "d", "s"), year=2020):
    rows = [(*area, year + i // 12, i % 12 + 1, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def column(df):
    return [r.v for r in df.orderBy(*AREA_KEYS, "year", "month").collect()]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1, None, 3], [1, 2, 3]),
        ([1, None, None, 4], [1, 2, None, 4]),
        ([None, 1, None, None, None], [None, 1, 1, None, None]),
        ([None, 2, None, None, 5, None, None], [None, 2, 3, None, 5, 5, None]),
    ],
)
def test_interpolation_limit_one(spark, values, expected):
    df = series(spark, [None if v is None else float(v) for v in values])
    assert column(fill.interpolate_gaps(df, ["v"])) == expected


@pytest.mark.parametrize("limit", [1, 2, 5])
def test_interpolation_like_pandas(spark, limit):
    rng = np.random.default_rng(7)
    values = [None if rng.random() < 0.5 else float(rng.integers(0, 100)) for _ in range(60)]
    expected = pd.Series(values, dtype=float).interpolate(limit=limit)
    got = pd.Series(column(fill.interpolate_gaps(series(spark, values), ["v"], limit)), dtype=float)
    pd.testing.assert_series_equal(got, expected)


def test_grid_spans_all_months_for_every_area(spark):
    rows = [("p", "d", "a", 2019, 11, 1.0), ("p", "d", "a", 2020, 2, 2.0), ("p", "d", "b", 2020, 1, 3.0)]
    grid = fill.month_grid(spark.createDataFrame(rows, SCHEMA), ["v"])
    assert column(grid) == [1.0, None, None, 2.0, None, None, 3.0, None]
    months = [(r.year, r.month) for r in grid.where("subdistrict = 'b'").orderBy("year", "month").collect()]
    assert months == [(2019, 11), (2019, 12), (2020, 1), (2020, 2)]


def test_rows_without_area_are_left_out_and_counted(spark):
    rows = [("p", None, "a", 2020, 1, 1.0), ("p", "d", "a", 2020, 1, 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert fill.count_null_keys(df).first().n_dropped == 1
    assert column(fill.month_grid(df, ["v"])) == [2.0]


def pandas_fill(df):
    """Month by month, level by level, on one machine."""
    def area(x):
        x = x.sort_values("t").copy()
        x["v"] = x["v"].interpolate(limit=1)
        return x.assign(v=x["v"].fillna(x.groupby("month")["v"].transform("mean")))

    parts = [area(x) for _, x in df.groupby(AREA_KEYS)]
    out = pd.concat(parts)
    for level in (["province", "district"], ["province"]):
        out["v"] = out["v"].fillna(out.groupby(level)["v"].transform("mean"))
    return out.assign(v=out["v"].fillna(out["v"].mean()))


def test_fill_panel_like_pandas(spark):
    rng = np.random.default_rng(3)
    rows = []
    for p in "PQ":
        for d in "xyz":
            for s in "ab":
                empty = p == "Q" and d == "x" or p == "P" and d == "y" and s == "b"
                for t in range(30):
                    known = rng.random() < 0.4 and not empty and not (d == "z" and t % 12 == 3)
                    rows.append((p, d, s, 2020 + t // 12, t % 12 + 1, float(rng.normal()) if known else None))
    df = pd.DataFrame(rows, columns=[*AREA_KEYS, "year", "month", "v"])
    expected = pandas_fill(df.assign(t=df.year * 12 + df.month)).sort_values([*AREA_KEYS, "year", "month"])
    panel = spark.createDataFrame(rows, SCHEMA)
    for keep in (fill.seasonal_store, lambda seasonal: seasonal):
        got = column(fill.fill_panel(panel, ["v"], keep=keep))
        assert None not in got
        np.testing.assert_allclose(got, expected["v"].to_numpy(), rtol=1e-12)


def test_fill_keeps_known_values(spark):
    df = series(spark, [1.5, None, None, 4.0, None, None, None])
    got = column(fill.fill_panel(df, ["v"]))
    assert got[0] == 1.5 and got[3] == 4.0


def test_empty_variable_stays_empty(spark):
    assert column(fill.fill_panel(series(spark, [None, None, None]), ["v"])) == [None, None, None]


def test_forward_backward(spark):
    df = series(spark, [None, 1.0, None, 3.0, None])
    assert column(fill.fill_forward_backward(df, AREA_KEYS, ["year", "month"], ["v"])) == [1, 1, 1, 3, 3]


def test_chunked_fill_equals_plain_fill(spark):
    rng = np.random.default_rng(5)
    rows = [
        ("p" if rng.random() < 0.7 else "q", f"d{rng.integers(3)}", f"s{i}", 2020, int(rng.integers(1, 13)),
         float(i) if rng.random() < 0.2 else None)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    order = ["year", "month", "district", "subdistrict"]
    plain = fill.fill_forward_backward(df, ["province"], order, ["v"])
    chunked = fill.fill_forward_backward(df, ["province"], order, ["v"], chunk=["year", "month"])
    assert sorted(plain.collect()) == sorted(chunked.select(plain.columns).collect())


def test_grid_and_area_fills_share_one_shuffle(spark, tmp_path):
    series(spark, [1.0, None, 3.0]).write.parquet(str(tmp_path / "p"))
    panel = spark.read.parquet(str(tmp_path / "p"))
    df = fill.fill_climatology(fill.interpolate_gaps(fill.month_grid(panel, ["v"]), ["v"]), ["v"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_bounds(spark):
    df = series(spark, [1.0] * 14)
    row = fill.time_bounds(df).select((F.col("last") - F.col("first")).alias("span")).first()
    assert row.span == 13
