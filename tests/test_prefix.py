"""Range means from running totals against means of the rows, before and after repairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from arealis.operators import explore, prefix
from arealis.registry import AREA_KEYS, PANEL_KEYS, PANEL_VARIABLES

JAN = 2019 * 12


def panel(spark, months, seed=1, areas=7, share=0.6):
    draw = random.Random(seed)
    rows = [
        ("p" if a < 5 else "q", f"d{a % 3}", f"s{a}" if a else None, m // 12, m % 12 + 1, *[draw.choice([None, draw.uniform(-5, 900)]) for _ in PANEL_VARIABLES])
        for m in months for a in range(areas) if draw.random() < share
    ]
    schema = "province string, district string, subdistrict string, year int, month int, " + ", ".join(f"{v} double" for v in PANEL_VARIABLES)
    return spark.createDataFrame(rows, schema).select(*PANEL_KEYS, *PANEL_VARIABLES)


def day(m):
    return dt.date(m // 12, m % 12 + 1, 15)


SPANS = [(JAN, JAN + 30), (JAN - 40, JAN + 2), (JAN + 3, JAN + 3), (JAN + 9, JAN + 17), (JAN + 20, JAN + 99), (JAN + 8, JAN + 2), (JAN + 90, JAN + 99), (JAN - 9, JAN - 1)]


def means(df, keys, variable):
    return {tuple(r[k] for k in keys): r[variable] for r in df.collect() if r[variable] is not None}


def same_as_plain(spark, folder, whole, level="Subdistrict"):
    keys = AREA_KEYS if level == "Subdistrict" else AREA_KEYS[:2]
    for a, b in SPANS:
        rows = explore.filter_range(whole.na.drop("any", subset=AREA_KEYS), day(a), day(b))
        want = means(explore.area_mean(rows, "LST", level), keys, "LST")
        got = means(prefix.range_mean(spark, folder, "LST", day(a), day(b), level), keys, "LST")
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) for k in want)


@pytest.mark.parametrize("level", ["Subdistrict", "District"])
def test_range_means_equal_means_of_rows(spark, tmp_path, level):
    whole = panel(spark, range(JAN, JAN + 30))
    prefix.write_prefix(whole, str(tmp_path / "t"))
    same_as_plain(spark, str(tmp_path / "t"), whole, level)


def test_a_range_reads_two_months(spark, tmp_path):
    folder = str(tmp_path / "t")
    prefix.write_prefix(panel(spark, range(JAN, JAN + 30)), folder)
    for (a, b), most in (((JAN + 5, JAN + 25), {f"year={m // 12}/month={m % 12 + 1}/" for m in (JAN + 4, JAN + 25)}), ((JAN, JAN + 3), {"year=2019/month=4/"})):
        files = prefix.range_totals(spark, folder, day(a), day(b)).inputFiles()
        assert {f.split("/months/")[1].rsplit("/", 1)[0] + "/" for f in files} == most


def test_repairs(spark, tmp_path):
    """A month rebuilt, months added with a gap, months before the first one: each time as written anew."""
    folder, whole = str(tmp_path / "t"), panel(spark, range(JAN, JAN + 20))
    prefix.write_prefix(whole, folder)
    steps = [(JAN + 7, JAN + 8, 5), (JAN + 25, JAN + 28, 6), (JAN + 20, JAN + 21, 7), (JAN - 4, JAN - 2, 8), (JAN, JAN + 1, 9)]
    at = F.col("year") * 12 + F.col("month") - 1
    for first, end, seed in steps:
        whole = whole.where(~at.between(first, end - 1)).unionByName(panel(spark, range(first, end), seed, areas=9)).persist()
        prefix.repair(whole.where(at >= first), folder, first)
        same_as_plain(spark, folder, whole)
        assert prefix.bounds(spark, folder) == tuple(whole.na.drop("any", subset=AREA_KEYS).agg(F.min(at), F.max(at)).first())


def test_a_repair_writes_later_months_only(spark, tmp_path):
    folder, whole = str(tmp_path / "t"), panel(spark, range(JAN, JAN + 20))
    prefix.write_prefix(whole, folder)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "months").rglob("*.parquet")}
    prefix.repair(whole.where(f"year * 12 + month - 1 >= {JAN + 15}"), folder, JAN + 15)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "months").rglob("*.parquet")}
    stay = {p for p in before if after.get(p) == before[p]}
    assert {(int(p.parts[-3][5:]), int(p.parts[-2][6:])) for p in stay} == {(m // 12, m % 12 + 1) for m in range(JAN, JAN + 15)}


def test_no_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    prefix.write_prefix(panel(spark, []), folder)
    assert prefix.bounds(spark, folder) is None
    assert prefix.range_mean(spark, folder, "LST", day(JAN), day(JAN + 3)).count() == 0
    prefix.repair(panel(spark, range(JAN, JAN + 4)), folder, JAN)
    assert prefix.bounds(spark, folder)[0] == JAN
    assert prefix.frames(spark, folder, "LST", [(day(JAN), day(JAN + k)) for k in range(3)]).select("frame").distinct().count() == 3
