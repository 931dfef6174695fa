"""Versioned ticks: equal to the batch fill, whole or not at all, and only as dear as the months they touch."""

import datetime as dt
import random

import pytest
from arealis.operators.fill import fill_forward_backward
from arealis.operators.merge import merge_long
from arealis.plans import ticks
from arealis.registry import AREA_KEYS, PANEL_KEYS, PANEL_VARIABLES, TIME_KEYS
from arealis.sources import versions
from arealis.streaming.ingest import release_months

LONG = "variable string, province string, district string, subdistrict string, year int, month int, value double"
VALUES = {"NDVI": 3000.0, "LST": 14800.0, "RAINFALL": 7.0, "SOILMOISTURE": 0.3, "FIRECOUNT": 2.0}


def raw_rows(months, areas=5, seed=1, share=0.5, variables=PANEL_VARIABLES):
    """Some of all areas, months (numbers) and variables."""
    draw = random.Random(seed)
    return [
        (v, "p", f"d{a % 2}", f"s{a}" if a else None, m // 12, m % 12 + 1, VALUES[v] * (1 + draw.random() / 50))
        for m in months for a in range(areas) for v in variables if draw.random() < share
    ]


def arrive(spark, rows, folder):
    spark.createDataFrame(rows, LONG).coalesce(1).write.mode("append").parquet(folder)


def panel_rows(df, order=None):
    return sorted(map(str, df.select(*(order or [*PANEL_KEYS, *PANEL_VARIABLES])).collect()))


def batch_panel(spark, rows, as_of):
    """What one pass over all rows gives; of repeated keys the first to arrive counts."""
    seen = {}
    for r in rows:
        seen.setdefault(r[:6], r)
    values = release_months(ticks.drop_incomplete(ticks.clean_stream(spark.createDataFrame(list(seen.values()), LONG)), ["value"]), as_of.year, as_of.month)
    return merge_long(values)


JAN = 2020 * 12
#: months of each arrival: in order, in order, a gap, late ones before all, late ones in the middle and new ones
ARRIVALS = [range(JAN, JAN + 5), range(JAN + 5, JAN + 9), range(JAN + 14, JAN + 16), range(JAN - 13, JAN - 11), [JAN + 3, JAN + 10, JAN + 17]]


def test_five_ticks_equal_the_batch_fill(spark, tmp_path):
    root, source, rows = str(tmp_path / "run"), str(tmp_path / "in"), []
    as_of = dt.date(2022, 1, 10)
    for k, months in enumerate(ARRIVALS):
        rows.append(raw_rows(months, seed=k, share=0.3 + 0.1 * k))
        arrive(spark, rows[-1], source)
        version = ticks.run_tick(spark, source, LONG, root, as_of)
        assert version.number == k + 1
        merged = batch_panel(spark, [r for part in rows for r in part], as_of)
        assert panel_rows(ticks.merged_panel(spark, root, version)) == panel_rows(merged)
        want = fill_forward_backward(merged, AREA_KEYS, TIME_KEYS, PANEL_VARIABLES)
        assert panel_rows(ticks.filled_panel(spark, root, version)) == panel_rows(want)
    some = ticks.filled_panel(spark, root, version, months=range(JAN, JAN + 2))
    assert {r.month for r in some.collect()} == {1, 2}
    assert len(some.inputFiles()) < len(ticks.filled_panel(spark, root, version).inputFiles())
    assert ticks.run_tick(spark, source, LONG, root, as_of) == version  # nothing new, nothing written


def test_a_tick_reads_and_writes_the_touched_months_only(spark, tmp_path, monkeypatch):
    root, source, as_of = str(tmp_path / "run"), str(tmp_path / "in"), dt.date(2023, 1, 10)
    arrive(spark, raw_rows(range(JAN, JAN + 30)), source)
    ticks.run_tick(spark, source, LONG, root, as_of)
    opened = []
    original = ticks.read_folders
    monkeypatch.setattr(ticks, "read_folders", lambda spark, base, folders, schema: opened.extend(f"{base[len(root) + 1:]}/{f}" for f in folders) or original(spark, base, folders, schema))

    def tick(months, seed):
        opened.clear()
        arrive(spark, raw_rows(months, seed=seed), source)
        v = ticks.run_tick(spark, source, LONG, root, as_of)
        return v, {f.split("/tick")[0].split("/batch")[0]: sorted(x for x in opened if x.startswith(f.split("/")[0])) for f in opened}

    v, found = tick([JAN + 30], 2)  # the next month
    assert found == {"clean": ["clean/batch=1/year=2022/month=7"], "merged": ["merged/tick=2/year=2022/month=7"], "snapshots": [f"snapshots/tick=1/point={JAN + 29}"]}
    assert [m for m, t in v.filled.items() if t == 2] == [JAN + 30] and sorted(v.snapshots) == [JAN + 11, JAN + 23, JAN + 30]
    v, found = tick([JAN + 27], 3)  # three months late: from the end of the year before
    assert found["snapshots"] == [f"snapshots/tick=1/point={JAN + 23}"] and len(found["merged"]) == 7
    assert sorted(m for m, t in v.filled.items() if t == 3) == [JAN + 27, JAN + 28, JAN + 29, JAN + 30]


def test_an_open_month_waits_until_it_is_over(spark, tmp_path):
    root, source = str(tmp_path / "run"), str(tmp_path / "in")
    arrive(spark, raw_rows(range(JAN, JAN + 4), share=1), source)
    first = ticks.run_tick(spark, source, LONG, root, dt.date(2020, 3, 20))
    assert max(first.merged) == JAN + 1 and max(first.clean) == JAN + 3
    later = ticks.run_tick(spark, source, LONG, root, dt.date(2020, 5, 1))
    assert max(later.merged) == JAN + 3 and later.number == 2
    assert ticks.merged_panel(spark, root, first).count() == 2 * 5 and ticks.merged_panel(spark, root, later).count() == 4 * 5


class Stopped(Exception):
    pass


#: everything a tick writes after the first one, in order
WRITES = ["clean", "arrivals", "merged", "filled", "snapshots", "versions"]


@pytest.mark.parametrize("at", WRITES)
def test_a_stopped_tick_changes_nothing_and_is_made_up_for(spark, tmp_path, monkeypatch, at):
    root, source, as_of = str(tmp_path / "run"), str(tmp_path / "in"), dt.date(2022, 1, 10)
    rows = raw_rows(range(JAN, JAN + 6))
    arrive(spark, rows, source)
    old = ticks.run_tick(spark, source, LONG, root, as_of)
    before = [panel_rows(f(spark, root, old)) for f in (ticks.merged_panel, ticks.filled_panel)]
    cleaned = panel_rows(ticks.clean_table(spark, root, old), ["variable", *PANEL_KEYS, "value"])
    more = raw_rows(range(JAN + 2, JAN + 9), seed=7)
    arrive(spark, more, source)

    from pyspark.sql.readwriter import DataFrameWriter

    def stopping(save):
        def write(self, path, *args, **kw):
            save(self, path, *args, **kw)
            if f"/run/{at}/" in path:
                raise Stopped(at)
        return write

    if at == "versions":  # before the manifest is there
        monkeypatch.setattr(ticks, "commit", lambda *a: (_ for _ in ()).throw(Stopped(at)))
    else:
        monkeypatch.setattr(DataFrameWriter, "parquet", stopping(DataFrameWriter.parquet))
    with pytest.raises(Exception, match=at):
        ticks.run_tick(spark, source, LONG, root, as_of)
    monkeypatch.undo()
    assert versions.current(spark, root) == old
    assert [panel_rows(f(spark, root, old)) for f in (ticks.merged_panel, ticks.filled_panel)] == before
    assert panel_rows(ticks.clean_table(spark, root, old), ["variable", *PANEL_KEYS, "value"]) == cleaned

    new = ticks.run_tick(spark, source, LONG, root, as_of)
    assert new.number == 2
    merged = batch_panel(spark, [*rows, *more], as_of)
    assert panel_rows(ticks.merged_panel(spark, root, new)) == panel_rows(merged)
    assert panel_rows(ticks.filled_panel(spark, root, new)) == panel_rows(fill_forward_backward(merged, AREA_KEYS, TIME_KEYS, PANEL_VARIABLES))
    # the earlier version is still there, whole
    assert panel_rows(ticks.filled_panel(spark, root, versions.current(spark, root, 1))) == before[1]


def test_ticks_by_province(spark, tmp_path):
    """One row per province and month, and all areas' rows carried within their province."""
    rows = [r for k, m in enumerate(ARRIVALS) for r in raw_rows(m, seed=k, share=0.3)]
    as_of = dt.date(2022, 1, 10)
    for name, keys in (("a", ["province", *TIME_KEYS]), ("b", PANEL_KEYS)):
        root, source = str(tmp_path / f"run{name}"), str(tmp_path / f"in{name}")
        for k in (0, 1):
            arrive(spark, rows[k::2], source)
            version = ticks.run_tick(spark, source, LONG, root, as_of, keys, ["province"])
        merged = ticks.merged_panel(spark, root, version)
        within = [c for c in keys if c not in ("province", *TIME_KEYS)]
        want = fill_forward_backward(merged, ["province"], [*TIME_KEYS, *within], PANEL_VARIABLES)
        columns = [*keys, *PANEL_VARIABLES]
        assert panel_rows(ticks.filled_panel(spark, root, version, ["province"]), columns) == panel_rows(want, columns)


def test_no_rows_no_version(spark, tmp_path):
    root, source = str(tmp_path / "run"), str(tmp_path / "in")
    arrive(spark, [], source)
    assert ticks.run_tick(spark, source, LONG, root, dt.date(2020, 1, 1)) == versions.Version()
    arrive(spark, [("RAINFALL", "p", "d", "s", None, 3, 1.0), ("RAINFALL", "p", "d", "s", 2019, 3, 1.0)], source)
    version = ticks.run_tick(spark, source, LONG, root, dt.date(2020, 1, 1))
    assert list(version.merged) == [2019 * 12 + 2] and ticks.filled_panel(spark, root, version).count() == 1
