from functools import reduce

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arealis.operators import clean, ranks
from arealis.registry import VARIABLES


def groups(spark, data):
    rows = [(k, None if v is None else float(v)) for k, vs in data.items() for v in vs]
    return spark.createDataFrame(rows, "k string, v double")


def test_quartiles_of_few(spark):
    q = ranks.exact_quantiles(groups(spark, {"a": [1, 2, 3, 10, None]}), ["k"], "v", {"q1": 0.25, "q3": 0.75}).first()
    assert (q.q1, q.q3) == (1.75, 4.75)


@pytest.mark.parametrize("accuracy", [40, 100, ranks.ACCURACY])
def test_quantiles_like_numpy(spark, accuracy):
    rng = np.random.default_rng(11)
    data = {
        "normal": rng.normal(0, 1, 501), "tailed": np.exp(rng.normal(0, 8, 400)) * rng.choice([-1, 1], 400),
        "copies": rng.choice([0.0, -0.0, 1.5, 2.0], 700), "one": [3.25], "two": [-1.0, 4.0], "equal": [0.1] * 9,
    }
    probs = {"p0": 0.0, "p1": 0.1, "p2": 0.25, "p3": 0.5, "p4": 0.9, "p5": 1.0}
    got = ranks.exact_quantiles(groups(spark, data), ["k"], "v", probs, accuracy).collect()
    assert len(got) == len(data)
    for r in got:
        np.testing.assert_allclose([r[p] for p in probs], np.quantile(data[r.k], list(probs.values())), rtol=1e-12)


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.2, 0.45])
def test_trimmed_mean_like_sorting(spark, ratio):
    rng = np.random.default_rng(13)
    data = {"wide": rng.normal(0, 1000, 333), "copies": rng.choice([1.0, 2.0, 7.0], 500), "few": [1.0, 2.0, 9.0], "hot": [5.0] * 400 + [1.0]}
    got = ranks.trimmed_mean(groups(spark, data), ["k"], "v", ratio, "t", accuracy=50).collect()
    for r in got:
        values = np.sort(data[r.k])
        cut = int(ratio * len(values))
        assert r.t == pytest.approx(values[cut : len(values) - cut].mean(), rel=1e-12)
    assert len(got) == len(data)


def test_trim_ratio_is_checked(spark):
    with pytest.raises(ValueError):
        ranks.trimmed_mean(groups(spark, {"a": [1]}), ["k"], "v", 0.5)


@pytest.mark.parametrize("k", [64, ranks.SKETCH_K])
def test_quantiles_from_merged_states(spark, k):
    """States of seven files, stored one by one; windows in use for the large groups with the small sketch."""
    rng = np.random.default_rng(17)
    data = {
        "normal": rng.normal(0, 1, 4001), "tailed": np.exp(rng.normal(0, 8, 3000)) * rng.choice([-1, 1], 3000),
        "copies": rng.choice([0.0, 1.5, 2.0], 2700), "one": [3.25], "none": [None, None],
    }
    rows = [(g, None if v is None else float(v), i % 7) for g, vs in data.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, v double, file int")
    parts = [ranks.quantile_state(df.where(F.col("file") == f), ["k"], "v", k) for f in range(7)]
    state = ranks.merged_state(reduce(lambda a, b: a.unionByName(b), parts), ["k"], k)
    probs = {"p0": 0.0, "p1": 0.1, "p2": 0.25, "p3": 0.5, "p4": 0.9, "p5": 1.0}
    got = ranks.exact_quantiles(df, ["k"], "v", probs, state=state, k=k).collect()
    assert {r.k for r in got} == set(data) - {"none"}
    for r in got:
        np.testing.assert_allclose([r[p] for p in probs], np.quantile(data[r.k], list(probs.values())), rtol=1e-12)
    if k == 64:
        left = ranks.ranked_values(df, ["k"], "v", [0.25, 0.75], state=state, k=k).groupBy("k").count().collect()
        assert {r.k: r["count"] for r in left}["normal"] < (4 * ranks.MARGIN * ranks.rank_error(k) + 0.05) * 4001


def test_a_state_of_other_rows_fails(spark):
    df = groups(spark, {"a": range(50), "b": range(9)})
    for other in (df.where("v < 40"), df.where("k = 'a'")):
        with pytest.raises(Exception, match="state of other rows"):
            ranks.exact_quantiles(df, ["k"], "v", {"q": 0.5}, state=ranks.quantile_state(other, ["k"], "v")).collect()


def test_a_state_saves_a_scan(spark, tmp_path):
    spark.range(2000).selectExpr("id % 3 AS k", "id / 7 AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    state = ranks.quantile_state(df, ["k"], "v")
    state.write.parquet(str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))

    def scans(**how):
        plan = ranks.exact_quantiles(df, ["k"], "v", {"q": 0.25}, **how)._jdf.queryExecution().executedPlan().toString()
        return plan.split("Initial Plan")[-1].count(f"{tmp_path}/t")

    assert (scans(), scans(state=kept)) == (2, 1)


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    got = {r.k: r.m for r in ranks.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_hot_group_without_broadcast(spark):
    """A third of all rows in one group; joins by shuffle give the same answer."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.xxhash64("id") % 100_000 / 7).alias("v")
    )
    expected = df.groupBy("k").agg(F.percentile("v", 0.25).alias("q")).collect()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ranks.exact_quantiles(df, ["k"], "v", {"q": 0.25}).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r.k: pytest.approx(r.q, rel=1e-12) for r in expected} == {r.k: r.q for r in got}


def test_close_values_are_spread(spark):
    """Values between 1.7e9 and 1.7e9 + 1e5: a small share of the group is left to sort."""
    df = spark.range(200_000).select(F.lit("a").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(100_000_000)) / 1000 + 1.7e9).alias("v"))
    left = ranks.ranked_values(df, ["k"], "v", [0.25, 0.75], 1000)
    assert left.count() < 200_000 * 2 * 3 * ranks.MARGIN / 1000
    got = ranks.exact_quantiles(df, ["k"], "v", {"q": 0.25}, 1000).first().q
    assert got == pytest.approx(df.agg(F.percentile("v", 0.25)).first()[0], rel=1e-15)


def raw(spark, rows):
    return spark.createDataFrame(
        [(v, "p", "d", f"s{i}", 2020, 1, x) for i, (v, x) in enumerate(rows)],
        "variable string, province string, district string, subdistrict string, year int, month int, value double",
    )


def test_ranges_and_sentinels(spark):
    rows = [
        ("NDVI", 5000.0), ("NDVI", 0.0), ("NDVI", 10001.0), ("NDVI", -2000.0), ("NDVI", -2001.0),
        ("LST", 13907.5), ("LST", 13907.4), ("LST", 20000.0),
        ("SOILMOISTURE", 0.0), ("SOILMOISTURE", 1.0), ("SOILMOISTURE", 1.01),
        ("RAINFALL", -0.1), ("RAINFALL", 0.0), ("FIRECOUNT", 3.0), ("FIRECOUNT", float("nan")), ("OTHER", 1.0),
    ]
    got = [r.value for r in clean.mask_rows(raw(spark, rows)).orderBy(F.expr("int(substr(subdistrict, 2))")).collect()]
    assert got == [
        0.5, None, None, -0.2, None, pytest.approx(5.0, abs=1e-9) if 13907.5 * 0.02 - 273.15 >= 5 else None, None, None,
        0.0, 1.0, None, None, 0.0, 3.0, None,
    ]


def test_iqr_scope_and_exempt_variables(spark):
    rows = [("LST", 14500.0 + i) for i in range(9)] + [("LST", 16000.0)] + [("RAINFALL", 1.0)] * 9 + [("RAINFALL", 5000.0)]
    got = clean.clean_long(raw(spark, rows)).groupBy("variable").agg(F.count("value").alias("n")).collect()
    assert {r.variable: r.n for r in got} == {"LST": 9, "RAINFALL": 10}


def test_iqr_like_pandas(spark):
    rng = np.random.default_rng(17)
    pdf = pd.DataFrame({"k": rng.integers(0, 4, 400), "v": rng.standard_t(2, 400)})
    pdf.loc[rng.random(400) < 0.1, "v"] = np.nan

    def bounded(s):
        q1, q3 = np.nanquantile(s, [0.25, 0.75])
        return s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))].count()

    rows = [(int(k), None if np.isnan(v) else float(v)) for k, v in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r.n for r in clean.iqr_mask(df, ["k"], "v").groupBy("k").agg(F.count("v").alias("n")).collect()}
    assert got == {k: bounded(s) for k, s in pdf.groupby("k")["v"]}


def test_single_variable_form_equals_long_form(spark):
    rows = [("NDVI", float(x)) for x in range(-3000, 12000, 500)]
    long = raw(spark, rows)
    wide = long.withColumnRenamed("value", "NDVI").drop("variable")
    a = [r.NDVI for r in clean.clean_variable(wide, "NDVI", "NDVI").orderBy("subdistrict").collect()]
    b = [r.value for r in clean.clean_long(long).orderBy("subdistrict").collect()]
    assert a == b


def test_registry_covers_the_rules():
    assert [n for n, v in VARIABLES.items() if v.iqr] == ["NDVI", "LST", "SOILMOISTURE"]
    assert {n: v.reducer for n, v in VARIABLES.items()} == {
        "NDVI": "mean", "LST": "mean", "SOILMOISTURE": "mean", "RAINFALL": "sum", "FIRECOUNT": "sum",
    }


def test_values_stay_where_they_are(spark):
    """The windows of few groups are broadcast: no group's values are shuffled to one task and sorted there."""
    df = groups(spark, {"a": [float(i % 97) for i in range(500)], "b": [1.0, 2.0, 4.0]})
    for found in (ranks.trimmed_mean(df, ["k"], "v", 0.1, "t"), clean.iqr_mask(df, ["k"], "v")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
        assert found.count() in (2, 503)
