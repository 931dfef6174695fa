import datetime as dt

import pytest
from pyspark.sql import functions as F

from arealis.functions.columns import require_columns
from arealis.operators import clean, explore, raster
from arealis.plans.batch import Tables, run_batch
from arealis.plans.incremental import due_month, run_tick, unfinished
from arealis.registry import PANEL_KEYS, PANEL_VARIABLES
from arealis.session import scratch_dir, stored
from arealis.sources import audit, files
from arealis.streaming import ingest, windows

RAW = "province string, district string, subdistric string, year int, month int, mean double, sum double"
LONG = "variable string, province string, district string, subdistrict string, year int, month int, value double"


def write(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def long_rows(spark, months=24, areas=6, variables=PANEL_VARIABLES, shift=0.0):
    scale = {"NDVI": 800.0, "LST": 50.0, "RAINFALL": 3.0, "SOILMOISTURE": 0.05, "FIRECOUNT": 1.0}
    base = {"NDVI": 1000.0, "LST": 14500.0}
    rows = [
        (v, "p", f"d{a % 2}", f"s{a}", 2020 + m // 12, m % 12 + 1, base.get(v, 0.0) + scale[v] * ((a * 7 + m * 3) % 11) + shift)
        for v in variables for m in range(months) for a in range(areas)
    ]
    return spark.createDataFrame(rows, LONG)


def test_variable_folders(spark, tmp_path):
    ndvi = spark.createDataFrame([("p", "d", "s", 2020, 1, 5000.0, None)], RAW).drop("sum")
    rain = spark.createDataFrame([("p", "d", "s", 2020, 1, None, 9.0)], RAW).drop("mean").withColumnRenamed("subdistric", "subdistrict")
    write(ndvi, tmp_path / "deep" / "ndvi")
    write(rain, tmp_path / "Rainfall")
    write(ndvi, tmp_path / "other")
    schema = "province string, district string, subdistric string, subdistrict string, year int, month int, mean double, sum double"
    got = files.read_variable_folders(spark, str(tmp_path), schema).collect()
    assert sorted((r.variable, r.subdistrict, r.value) for r in got) == [("NDVI", "s", 5000.0), ("RAINFALL", "s", 9.0)]


def test_listing(spark, tmp_path):
    for name in ("NDVI/NDVI_2020_02.geojson", "NDVI/NDVI_2020_01.geojson", "Rainfall/Rainfall_2020_01.geojson", "NDVI/readme.txt", "top.geojson"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("{}")
    every = files.list_inputs(spark, str(tmp_path), min_depth=1)
    assert [r.stem for r in every.collect()] == ["NDVI_2020_01", "NDVI_2020_02", "Rainfall_2020_01"]
    assert files.list_inputs(spark, str(tmp_path), variable="ndvi", limit=1).first().stem == "NDVI_2020_01"
    assert files.list_inputs(spark, str(tmp_path), limit=0).count() == 4
    finished = spark.createDataFrame([("NDVI_2020_01",)], "stem string")
    assert sorted(r.stem for r in files.pending(every, finished).collect()) == ["NDVI_2020_02", "Rainfall_2020_01"]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", 2020, 1.0), ("A", 2021, 2.0), ("B", 2020, 3.0)], "variable string, year int, v double")
    files.write_table(df, path, ["variable", "year"])
    files.write_table(spark.createDataFrame([("A", 2021, 9.0)], df.schema), path, ["variable", "year"], only_present=True)
    got = files.scan_partitioned(spark, path)
    assert sorted((r.variable, r.year, r.v) for r in got.collect()) == [("A", 2020, 1.0), ("A", 2021, 9.0), ("B", 2020, 3.0)]
    only = files.scan_partitioned(spark, path, ["B"])
    assert "PartitionFilters: [isnotnull(variable" in only._jdf.queryExecution().executedPlan().toString()
    assert only.count() == 1


def test_bucketed_pixels_need_no_shuffle(spark, tmp_path):
    pixels = spark.range(500).select(
        (F.col("id") % 40).alias("pixel"), F.timestamp_seconds(F.col("id") * 50_000).alias("image_ts"), (F.col("id") % 7).cast("double").alias("v")
    )
    saved = files.write_bucketed(pixels, "bucketed_pixels", str(tmp_path / "t"), ["pixel"], 4)
    try:
        df = raster.composite(saved, ["pixel"], {"v": "mean"})
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(df.collect()) == sorted(raster.composite(pixels, ["pixel"], {"v": "mean"}).collect())
    finally:
        spark.sql("DROP TABLE bucketed_pixels")


def test_attributes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Province,Sub Area,NDVI\np,x,0.5\nq,y,\n")
    got = files.read_attributes(spark, str(path), "Province string, `Sub Area` string, NDVI double")
    assert got.columns == ["province", "sub_area", "ndvi"]
    assert [r.ndvi for r in got.collect()] == [0.5, None]


def test_audit_reports_missing_and_broken(spark, tmp_path):
    write(spark.createDataFrame([("p", "d", "s", 2020, 1, 1.0, 1.0)], RAW), tmp_path / "a")
    write(spark.createDataFrame([("p", "d", "s", 2020, 1, 2.0)], RAW.replace("subdistric", "subdistrict").replace(", sum double", "")), tmp_path / "b")
    (tmp_path / "broken.parquet").write_text("not parquet")
    found = audit.file_schemas(spark, str(tmp_path)).collect()
    by = {("error" if r.error else ",".join(r.missing) or "ok"): r for r in found}
    assert set(by) == {"subdistrict", "ok", "error"}
    assert sorted(by["subdistrict"].extra) == ["mean", "subdistric", "sum"]
    assert [r.n_files for r in audit.schema_summary(audit.file_schemas(spark, str(tmp_path))).collect()] == [1, 1]


def test_batch_job_needs_its_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="value"):
        run_batch(spark, long_rows(spark).drop("value"), Tables(str(tmp_path)))
    assert require_columns(long_rows(spark), PANEL_KEYS) is not None


def test_batch_job_writes_every_stage(spark, tmp_path):
    tables = Tables(str(tmp_path / "run"))
    result = run_batch(spark, long_rows(spark), tables)
    assert result.count() == 6 * 2
    filled = spark.read.parquet(tables.filled)
    assert filled.count() == 6 * 24
    assert filled.where(" OR ".join(f"{v} IS NULL" for v in PANEL_VARIABLES)).count() == 0


def test_ingest_reads_each_file_once_and_repeats_nothing(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first, again = long_rows(spark, 12), long_rows(spark, 14, shift=1.0)
    write(first, source)
    for extra in (None, again):
        if extra is not None:
            write(extra, source)
        for _ in range(2):
            ingest.ingest(spark, source, first.schema, target, check)
    got = files.scan_partitioned(spark, target)
    expected = clean.drop_incomplete(clean.mask_rows(first.union(again.where("year = 2021"))), ["value"])
    columns = ["variable", *PANEL_KEYS, "value"]
    assert sorted(got.select(columns).collect(), key=str) == sorted(expected.select(columns).collect(), key=str)


def test_replayed_batch_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    write_batch = ingest.append_unseen(target, ["variable", *PANEL_KEYS], ["value"], ["variable", "year"])
    batch = long_rows(spark, 12)
    for batch_id in (0, 0, 1):
        write_batch(batch, batch_id)
    assert spark.read.parquet(target).count() == batch.count()


def test_released_months_equal_the_batch_rules(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    raw = long_rows(spark, 15, areas=12)
    write(raw, source)
    ingest.ingest(spark, source, raw.schema, target, str(tmp_path / "check"))
    released = ingest.release_months(files.scan_partitioned(spark, target), 2021, 3)
    columns = ["variable", *PANEL_KEYS, "value"]
    expected = clean.clean_long(raw).where("year = 2020 OR month < 3")
    assert sorted(released.select(columns).collect(), key=str) == sorted(expected.select(columns).collect(), key=str)


def test_ticks(spark, tmp_path):
    tables, source = Tables(str(tmp_path / "run")), str(tmp_path / "in")
    raw = long_rows(spark, 16)
    write(raw.where("year = 2020"), source)
    first = run_tick(spark, source, raw.schema, tables, dt.date(2020, 12, 20))
    assert first.agg(F.max("month")).first()[0] == 11
    assert due_month(first, dt.date(2020, 12, 20)) is None and due_month(first, dt.date(2021, 1, 2)) == (2020, 12)
    write(raw.where("year = 2021"), source)
    for _ in range(2):  # December 2020 was still open at the first tick
        panel = run_tick(spark, source, raw.schema, tables, dt.date(2021, 4, 2))
        assert panel.count() == 6 * 15
        assert unfinished(panel, dt.date(2021, 4, 2)).count() == 0


def events(spark, days):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h), z, float(d + h)) for d in range(days) for h in (1, 13) for z in "ab"]
    return spark.createDataFrame(rows, "ts timestamp, z string, value double")


def test_days_are_released_when_closed(spark, tmp_path):
    write(events(spark, 40), tmp_path / "in")
    stream = ingest.new_files(spark, str(tmp_path / "in"), "ts timestamp, z string, value double")
    windows.append_available(windows.daily_zonal(stream, ["z"], "value"), str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = windows.daily_zonal(spark.read.parquet(str(tmp_path / "in")), ["z"], "value")
    closed = batch.where("day < date'2024-02-08'")
    assert sorted(got.collect()) == sorted(closed.collect())
    monthly = windows.monthly_from_daily(got, ["z"]).where("month = 1").orderBy("z").first()
    assert (monthly.n, monthly["sum"]) == (62, sum(d + h for d in range(31) for h in (1, 13)))


@pytest.mark.parametrize("grace, months", [(0, [1, 2, 3]), (1, [1, 2])])
def test_months_are_released_after_later_rows(spark, tmp_path, grace, months):
    write(events(spark, 100), tmp_path / "in")
    stream = ingest.new_files(spark, str(tmp_path / "in"), "ts timestamp, z string, value double")
    windows.append_available(windows.closed_months(stream, ["z"], "value", grace_months=grace), str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out")).where("z = 'a'").orderBy("month").collect()
    assert [r.month for r in got] == months and got[0].n == 62


def test_late_rows_of_a_released_month_are_dropped(spark, tmp_path):
    def run():
        stream = ingest.new_files(spark, str(tmp_path / "in"), "ts timestamp, z string, value double")
        windows.append_available(windows.closed_months(stream, ["z"], "value", 0), str(tmp_path / "out"), str(tmp_path / "check"))
        got = spark.read.parquet(str(tmp_path / "out")).where("z = 'a'").orderBy("month").collect()
        return [(r.month, r.n) for r in got]

    write(events(spark, 60), tmp_path / "in")  # January, February
    assert run() == [(1, 62)]
    late = events(spark, 1)
    more = spark.createDataFrame([(dt.datetime(2024, 2, 29, 20), "a", 1.0), (dt.datetime(2024, 3, 2), "a", 1.0)], late.schema)
    write(late.union(more), tmp_path / "in")
    assert run() == [(1, 62), (2, 59)]


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    assert root is None or path.startswith(root)
    assert stored(spark.range(3).toDF("n"), "three").count() == 3


def test_late_variable_completes_its_rows(spark, tmp_path):
    tables, source = Tables(str(tmp_path / "run")), str(tmp_path / "in")
    raw = spark.createDataFrame([("p", "d", "s", 2020, 1, "RAINFALL", 10.0), ("p", "d", "s", 2020, 1, "FIRECOUNT", 3.0)], "province string, district string, subdistrict string, year int, month int, variable string, value double")
    for v, fires in (("RAINFALL", None), ("FIRECOUNT", 3.0)):
        write(raw.where(F.col("variable") == v), source)
        row = run_tick(spark, source, raw.schema, tables, dt.date(2020, 3, 1)).first()
        assert (row.RAINFALL, row.FIRECOUNT) == (10.0, fires)


def test_tick_by_province(spark, tmp_path):
    raw = long_rows(spark, 16)
    write(raw, str(tmp_path / "in"))
    keys = ["province", "year", "month"]
    panel = run_tick(spark, str(tmp_path / "in"), raw.schema, Tables(str(tmp_path / "run")), dt.date(2020, 6, 2), keys, ["province"])
    assert panel.count() == panel.select(*keys).distinct().count() == 5 * raw.select("province").distinct().count()


def test_ledger_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(4000).select(F.timestamp_seconds("id").alias("ts"), F.col("id").alias("z"), F.lit(1.0).alias("value"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        windows.add_to_ledger(str(tmp_path), ["z"], "value", 0)(rows, 0)
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "batch=0").glob("part-*.parquet"))) > 1


def test_ledger_holds_every_row(spark, tmp_path):
    folder, order = str(tmp_path / "ledger"), [3, 1, 2, 6]
    for grace, late in ((5, 0), (0, 62 + 58)):
        put = windows.add_to_ledger(f"{folder}{grace}", ["z"], "value", grace)
        for i, month in enumerate(order):
            rows = [(dt.datetime(2024, month, d, h), "a", float(d)) for d in range(1, 30 if month != 1 else 32) for h in (1, 13)]
            for _ in range(2):  # a repeated batch replaces itself
                put(spark.createDataFrame(rows, "ts timestamp, z string, value double"), i)
        got = windows.released_months(spark, f"{folder}{grace}", ["z"], grace)
        assert [r.month for r in got.orderBy("month").collect()] == ([] if grace else [3])
        assert (windows.late_rows(spark, f"{folder}{grace}", ["z"]).agg(F.sum("n_rows")).first()[0] or 0) == late


def test_map_shows_plain_rounding(spark):
    shown = explore.value_range(spark.createDataFrame([(0.0004998,)], "v double"), "v").first()
    assert shown.min_value == 0.0


def test_rerun_replaces_the_table(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int")
    for part in (rows, rows.where("k = 'A'")):
        files.write_table(part, str(tmp_path / "t"), ["k"])
    assert [r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()] == ["A"]


def test_a_run_removes_its_scratch(spark, tmp_path):
    from pathlib import Path

    from arealis.session import scratch_run

    with scratch_run(spark) as folder:
        kept = stored(spark.range(3).toDF("n"), "three")
        with scratch_run(spark) as inner:
            assert inner == folder
        assert kept.count() == 3 and list(Path(folder.removeprefix("file:")).glob("three-*"))
    assert not Path(folder.removeprefix("file:")).exists()
    with pytest.raises(KeyError), scratch_run(spark) as folder:
        stored(spark.range(3).toDF("n"), "three")
        raise KeyError
    assert not Path(folder.removeprefix("file:")).exists() and "run-" not in scratch_dir(spark, "x")
