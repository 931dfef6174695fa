"""Open months in a stream: closed once, late rows counted, state over restarts."""

import datetime as dt
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from arealis.streaming import ingest, months

EVENTS = "ts timestamp, z string, value decimal(12,2)"


def day(year, month, d, h=5):
    return dt.datetime(year, month, d, h)


def arrive(spark, rows, folder, schema=EVENTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def run(spark, root, grace, schema=EVENTS, zone=("z",), value="value", files=None):
    found = months.open_months(ingest.new_files(spark, f"{root}/in", schema, max_files=files), list(zone), value, grace)
    months.run_months(found, f"{root}/out", f"{root}/check")
    return found.schema


def expected(arrivals, grace):
    """Closed months and late rows after each arrival is one micro-batch: loops over the rows."""
    clock, held, closed, late = None, defaultdict(list), {}, defaultdict(list)
    for rows in arrivals:
        for ts, z, v in rows:
            at = None if ts is None else ts.year * 12 + ts.month - 1
            if at is None or clock is not None and at < clock - grace:
                late[at, z].append(v)
            else:
                held[at, z].append(v)
        newest = [ts.year * 12 + ts.month - 1 for ts, _, _ in rows if ts is not None]
        clock = max([*newest, *([clock] if clock is not None else [])], default=None)
        for key in [k for k in held if clock is not None and k[0] < clock - grace]:
            closed[key] = held.pop(key)
    total = lambda v: (sum((x for x in v if x is not None), Decimal(0)) if any(x is not None for x in v) else None, len(v))
    return {k: total(v) for k, v in closed.items()}, {k: total(v) for k, v in late.items()}


def number(r):
    return None if r.year is None else r.year * 12 + r.month - 1


@pytest.mark.parametrize("grace", [0, 2])
def test_closed_and_late_rows_over_restarts(spark, tmp_path, grace):
    root, v = str(tmp_path), Decimal("1.25")
    arrivals = [
        [(day(2024, m, d), z, v * d) for m in (1, 2, 3) for d in (1, 28) for z in "ab"] + [(None, "a", v), (day(2024, 2, 9), None, None)],
        [(day(2024, 2, 3), "a", v), (day(2024, 3, 31, 23), "b", None), (day(2024, 4, 1, 0), "a", v)],
        [(day(2024, 1, 31), "b", None), (day(2024, 1, 30), "c", v), (day(2024, 7, 2), "c", v)],
        [(day(2023, 12, 31), "a", v), (day(2024, 6, 30), "a", v), (day(2024, 7, 9), "a", v), (day(1955, 1, 1), "old", v)],
    ]
    for k, rows in enumerate(arrivals):
        arrive(spark, rows, f"{root}/in")
        schema = run(spark, root, grace)  # each run starts from the checkpoint
        closed, late = expected(arrivals[: k + 1], grace)
        got = months.closed(spark, f"{root}/out", schema).collect()
        assert {(number(r), r.z): (r["sum"], r.n_rows) for r in got} == closed and len(got) == len(closed)
        assert {(number(r), r.z): (r["sum"], r.n_rows) for r in months.late(spark, f"{root}/out", schema, ["z"]).collect()} == late
    run(spark, root, grace)  # nothing new
    assert months.closed(spark, f"{root}/out", schema).count() == len(closed)


def test_micro_batches_of_one_run(spark, tmp_path):
    """Four files, one a micro-batch: the same as four runs."""
    root, arrivals = str(tmp_path), [[(day(2024, m, 5), "a", Decimal(m))] for m in (1, 3, 2, 6)]
    for rows in arrivals:
        arrive(spark, rows, f"{root}/in")
    schema = run(spark, root, 0, files=1)
    closed, late = expected(arrivals, 0)
    assert {number(r): r["sum"] for r in months.closed(spark, f"{root}/out", schema).collect()} == {k[0]: v[0] for k, v in closed.items()}
    assert {number(r): r["sum"] for r in months.late(spark, f"{root}/out", schema, ["z"]).collect()} == {k[0]: v[0] for k, v in late.items()}


def test_whole_numbers_doubles_and_several_zones(spark, tmp_path):
    rows = [(day(2024, m, d), "a", d % 2, d, float(d)) for m in (1, 2) for d in range(1, 29)]
    schema = "ts timestamp, z string, k int, n_fires int, level double"
    for value, kind in (("n_fires", int), ("level", float)):
        root = str(tmp_path / value)
        arrive(spark, rows, f"{root}/in", schema)
        found = run(spark, root, 0, schema, ("z", "k"), value)
        got = {r.k: r["sum"] for r in months.closed(spark, f"{root}/out", found).collect()}
        assert got == {k: sum(d for d in range(1, 29) if d % 2 == k) for k in (0, 1)} and type(got[0]) is kind


def test_nothing_arrived(spark, tmp_path):
    arrive(spark, [], f"{tmp_path}/in")
    schema = run(spark, str(tmp_path), 0)
    assert months.closed(spark, f"{tmp_path}/out", schema).count() == 0
    assert months.late(spark, f"{tmp_path}/none", schema, ["z"]).count() == 0


def test_rows_are_summed_before_they_are_shuffled(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("timestamp_seconds(1704067200 + id) AS ts", "'hot' AS z", "cast(id AS decimal(12,2)) AS value")
    found = months.partial_sums(rows.coalesce(1), ["z"], "value", "ts")
    got = found.collect()
    assert len(got) <= 3 and sum(r.n_rows for r in got) == 20_000 and sum(r["sum"] for r in got) == sum(range(20_000))
    assert Counter((r.year, r.month) for r in got) == Counter({(2024, 1): len(got)})


def test_the_session_keeps_its_state_store(spark):
    before = spark.conf.get(months.PROVIDER, None)
    with months.keyed_state(spark):
        assert spark.conf.get(months.PROVIDER) == months.ROCKSDB
    assert spark.conf.get(months.PROVIDER, None) == before
