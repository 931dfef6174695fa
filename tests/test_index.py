"""Only files that can match are opened, and no row is missed."""

import datetime as dt
import random

import pytest

from arealis.operators.explore import filter_area, filter_range
from arealis.sources import index
from arealis.sources.index import Wanted


def panel(spark, n=4000, seed=1):
    draw = random.Random(seed)
    rows = [
        (draw.choice(["A", "B", "C", None]), f"d{draw.randrange(5)}", f"s{draw.randrange(9)}", draw.choice([2019, 2020, 2021, None]), draw.randrange(1, 13), float(k))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, "province string, district string, subdistrict string, year int, month int, v double")


WANTED = [
    Wanted(), Wanted(dt.date(2020, 3, 1), dt.date(2020, 3, 1)), Wanted(dt.date(2020, 11, 1)), Wanted(end=dt.date(2019, 2, 1)),
    Wanted(province="B"), Wanted(dt.date(2020, 1, 1), dt.date(2020, 6, 1), "C", "d1", "s3"), Wanted(province="none"),
    Wanted(dt.date(2030, 1, 1)), Wanted(dt.date(2021, 5, 1), dt.date(2021, 2, 1)),
]


def plain(df, w):
    rows = filter_range(df, w.start or dt.date(1, 1, 1), w.end or dt.date(9999, 12, 1)) if w.start or w.end else df
    rows = filter_area(rows, w.province, w.district)
    return sorted(r.v for r in (rows.where(rows.subdistrict == w.subdistrict) if w.subdistrict else rows).collect())


@pytest.mark.parametrize("order", [None, ["year", "month"], ["v"]])
def test_wanted_rows_and_no_other_files(spark, tmp_path, order):
    folder, df = str(tmp_path / "t"), panel(spark)
    index.write_indexed(df, folder, 24, order)
    every = len(index.matching_files(spark, folder, Wanted()))
    assert 12 < every <= 24
    for w in WANTED:
        found = index.read_indexed(spark, folder, w)
        assert sorted(r.v for r in found.collect()) == plain(df, w)
        assert len(found.inputFiles()) == len(index.matching_files(spark, folder, w))
    if order != ["v"]:  # ordered by what is asked for
        assert len(index.matching_files(spark, folder, WANTED[1])) < every / 2
        assert index.matching_files(spark, folder, Wanted(dt.date(2030, 1, 1))) == []


def test_files_the_index_does_not_know_are_read(spark, tmp_path):
    folder, df, more = str(tmp_path / "t"), panel(spark, 500), panel(spark, 300, 2)
    index.write_indexed(df, folder, 6)
    more.write.mode("append").parquet(folder)
    for w in WANTED:
        assert sorted(r.v for r in index.read_indexed(spark, folder, w).collect()) == sorted(plain(df, w) + plain(more, w))
    before = len(index.matching_files(spark, folder, Wanted(dt.date(2030, 1, 1))))
    index.write_index(spark, folder)
    assert before > 0 and index.matching_files(spark, folder, Wanted(dt.date(2030, 1, 1))) == []


def test_without_an_index(spark, tmp_path):
    folder, df = str(tmp_path / "t"), panel(spark, 200)
    df.write.parquet(folder)
    assert sorted(r.v for r in index.read_indexed(spark, folder, WANTED[1]).collect()) == plain(df, WANTED[1])
