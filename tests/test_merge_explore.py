import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from arealis.functions import columns as c
from arealis.operators import explore, merge
from arealis.registry import canonical_variable

PANEL = "province string, district string, subdistrict string, year int, month int, v double"


def small(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("unique", [True, False])
def test_outer_merge_matches_null_keys(spark, unique):
    a = small(spark, [("x", 1), (None, 2), ("y", None)])
    b = small(spark, [("x", 10), (None, 20), ("z", 30)], "k string, w int")
    got = rows(merge.outer_merge([a, b], ["k"], unique))
    assert got == sorted([("x", 1, 10), (None, 2, 20), ("y", None, None), ("z", None, 30)], key=str)


def test_outer_merge_with_repeated_keys(spark):
    a, b = small(spark, [("x", 1), ("x", 2)]), small(spark, [("x", 10), ("x", 20)], "k string, w int")
    assert merge.outer_merge([a, b], ["k"], unique=False).count() == 4
    with pytest.raises(PySparkException, match="repeated key"):
        merge.outer_merge([a, b], ["k"]).collect()


def test_merge_long_refuses_repeated_keys(spark):
    long = small(spark, [("x", "A", 1.0), ("x", "A", None)], "k string, variable string, value double")
    with pytest.raises(PySparkException, match="repeated key"):
        merge.merge_long(long, ["A"], ["k"]).collect()


def test_concat_fills_missing_columns(spark):
    got = rows(merge.concat_all([small(spark, [("x", 1)]), small(spark, [("y",)], "k string")]))
    assert got == [("x", 1), ("y", None)]


def test_upsert_old_wins_and_is_idempotent(spark):
    old, new = small(spark, [("x", 5), (None, 1)]), small(spark, [("x", 1), ("y", 9), ("y", 3), (None, 0)])
    once = merge.upsert_keep_first(old, new, ["k"], ["v"])
    assert rows(once) == sorted([("x", 5), ("y", 3), (None, 1)], key=str)
    for unique in (True, False):
        assert rows(merge.upsert_keep_first(old, new, ["k"], ["v"], unique)) == rows(once)
        assert rows(merge.upsert_keep_first(once, new, ["k"], ["v"], unique)) == rows(once)


def test_unseen_matches_null_keys(spark):
    assert rows(merge.unseen(small(spark, [("x", 1), (None, 2), ("y", 3)]), small(spark, [("x", 0), (None, 0)]), ["k"])) == [("y", 3)]


def test_range_and_empty_range(spark):
    df = small(spark, [("p", "d", "s", 2020, m, float(m)) for m in range(1, 13)], PANEL)
    kept = explore.filter_range(df, dt.date(2020, 3, 1), dt.date(2020, 5, 1))
    assert sorted(r.month for r in kept.collect()) == [3, 4, 5]
    assert explore.filter_range(df, dt.date(2020, 5, 1), dt.date(2020, 3, 1)).count() == 0


def test_range_reaches_the_scan(spark, tmp_path):
    small(spark, [("p", "d", "s", 2020, 1, 1.0)], PANEL).write.partitionBy("year").parquet(str(tmp_path / "p"))
    df = explore.area_mean(explore.filter_range(spark.read.parquet(str(tmp_path / "p")), dt.date(2020, 1, 1), dt.date(2021, 1, 1)), "v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "year" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<province:string,district:string,subdistrict:string,month:int,v:double>" in plan


def test_image_month_is_half_open(spark):
    stamps = [dt.datetime(2020, 12, 1), dt.datetime(2020, 12, 31, 23, 59), dt.datetime(2021, 1, 1)]
    df = small(spark, [(t,) for t in stamps], "image_ts timestamp")
    assert explore.filter_month(df, 2020, 12).count() == 2


def test_extremes_break_ties_by_key(spark):
    df = small(spark, [("p", "d", "b", 1.0), ("p", "d", "a", 1.0), ("q", "d", "a", None)], "province string, district string, subdistrict string, v double")
    assert tuple(explore.area_extremes(df, "v").first()) == (1.0, "p, d, a", 1.0, "p, d, a")
    assert explore.area_extremes(df.where("v > 5"), "v").count() == 0


def test_next_month(spark):
    df = small(spark, [("p", "d", "s", 2020, 12, 1.0), ("p", "d", "s", 2019, 5, 1.0)], PANEL)
    assert tuple(explore.next_month(df, dt.date(2021, 2, 1)).first()) == (2021, 1)
    for day in (dt.date(2021, 1, 31), dt.date(2020, 12, 5)):
        assert explore.next_month(df, day).count() == 0


def test_slider_labels(spark):
    df = small(spark, [("p", "d", "s", 2020 + i // 12, i % 12 + 1, 1.0) for i in range(15)], PANEL)
    ticks = [r.tick_label for r in explore.slider_index(df).orderBy("position").collect()]
    assert [i for i, t in enumerate(ticks) if t] == [0, 12, 14] and ticks[12] == "2021-01"


def test_frames_are_cyclic(spark):
    df = small(spark, [("p", "d", "s", 2020, m, 1.0) for m in (1, 2, 3)], PANEL)
    assert sorted((r.frame, r.next_frame) for r in explore.map_frames(df, "v").collect()) == [(0, 1), (1, 2), (2, 0)]


def test_unknown_level_means_subdistrict(spark):
    df = small(spark, [("p", "d", "s", 2020, 1, 1.0)], PANEL)
    assert explore.area_mean(df, "v", "Country").columns == ["province", "district", "subdistrict", "v"]


def test_rows_without_area_have_no_mean(spark):
    df = small(spark, [("p", "d", None, 2020, 1, 9.0), ("p", "d", "s", 2020, 1, 1.0)], PANEL)
    assert rows(explore.area_mean(df, "v")) == [("p", "d", "s", 1.0)]
    assert explore.area_mean(df, "v", "District").first().v == 5.0
    assert explore.kpi_row(df, "v", dt.date(2020, 1, 1)).first().max_value == "1.0000"


def test_weighted_summary(spark):
    df = small(spark, [(1.0, 3.0), (5.0, 1.0), (None, 9.0)], "v double, w double")
    assert explore.value_range(df, "v").first().mean_value == 3.0
    assert explore.value_range(df, "v", weight="w").first().mean_value == 2.0
    assert explore.value_range(df.where("v IS NULL"), "v").count() == 0


def test_columns(spark):
    df = small(spark, [("a", "b", 1)], "` Province ` string, Subdistric string, `Fire Count` int")
    assert c.normalize_columns(df).columns == ["province", "subdistrict", "fire_count"]
    assert c.normalize_columns(df, lower=False).columns == ["Province", "Subdistrict", "Fire_Count"]
    assert c.missing_columns(df, ["x", "Subdistric"]) == ["x"]
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        c.require_columns(df, ["y", "x", "Subdistric"])


def test_upper_keys_keep_nulls(spark):
    assert rows(c.upper_keys(small(spark, [("a", 1), (None, 2)]), ["k"])) == sorted([("A", 1), (None, 2)], key=str)


def test_months(spark):
    df = small(spark, [(2019, 12), (2020, 1), (2020, 2)], "year int, month int").withColumn("n", c.month_number())
    back = df.select("year", "month", c.year_of(F.col("n")).alias("y"), c.month_of(F.col("n")).alias("m"), "n").collect()
    assert all((r.year, r.month) == (r.y, r.m) for r in back) and [r.n - back[0].n for r in back] == [0, 1, 2]
    texts = small(spark, [("2020-03",), (" 2020-03-17",), ("March",), (None,)], "t string")
    assert [r.d for r in texts.select(c.parse_month("t").alias("d")).collect()] == [dt.date(2020, 3, 1)] * 2 + [None] * 2


def test_aliases():
    assert canonical_variable(" precipitation") == "RAINFALL" and canonical_variable("SoilMoisture") == "SOILMOISTURE"


def test_first_of_one_value_is_hashed(spark):
    """With one column besides the keys, which is the order too, the first row is its least value: no sort for the aggregate."""
    df = spark.createDataFrame([("a", 2.0), ("a", None), ("a", 1.0), ("b", None), (None, 3.0), (None, 4.0)], "k string, v double")
    found = merge.keep_first(df, ["k"], ["v"])
    assert sorted(found.collect(), key=str) == sorted([("a", 1.0), ("b", None), (None, 3.0)], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
