"""Every operator as a query over the supplied tables.

Each entry takes the session and the table folder and returns a DataFrame over whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions import columns as c
from arealis.functions.dtw import dtw_arrow, dtw_column, is_complete
from arealis.functions.geometry import covers, zone_area, zone_edges
from arealis.operators import anomaly, arcs, clean, explore, fill, merge, prefix, ranks, raster, shares, zones
from arealis.plans import binding as b
from arealis.plans import dashboard, incremental, ticks
from arealis.plans.batch import Tables, run_batch
from arealis.registry import AREA_KEYS, PANEL_KEYS, PANEL_VARIABLES, VARIABLES
from arealis.session import scratch_dir, stored
from arealis.sources import audit, files, geojson, index
from arealis.streaming import ingest, months, windows

FIRST = dt.date(1995, 1, 1)
START, END = dt.date(1996, 3, 1), dt.date(1999, 8, 1)
PROVINCE, DISTRICT = "ASIA", "NATION_2"
AS_OF = dt.date(2002, 6, 15)
IMAGE_MONTH = (1998, 5)
SPLIT_YEAR = 1999

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def settle(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded so that the order of addition does not show."""
    return c.settle_doubles(df, digits)


# --- sources and sinks -------------------------------------------------------------------------


@query
def scan_panel(spark, sf):
    orders = files.scan_parquet(spark, sf, "orders.parquet")
    return settle(
        orders.groupBy(F.year("o_orderdate").alias("year")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
        )
    )


@query
def variable_from_path(spark, sf):
    """Raw values written to a folder per variable, one of them unknown, and read back by path."""
    folder = scratch_dir(spark, "raw")
    raw = stored(b.raw_long(spark, sf), "raw")
    for v in [*PANEL_VARIABLES, "Unknown"]:
        rule = VARIABLES.get(v)
        rows = raw.where(F.col("variable") == (v if rule else "NDVI"))
        reducer = rule.reducer if rule else "mean"
        named = rows.withColumnRenamed("value", reducer).withColumnRenamed("subdistrict", "subdistric")
        named.drop("variable").write.parquet(f"{folder}/{v.lower()}")
    schema = "province string, district string, subdistric string, year int, month int, mean double, sum double"
    return settle(files.read_variable_folders(spark, folder, schema))


@query
def list_inputs(spark, sf):
    return files.list_inputs(spark, sf, "*.parquet").select("stem", (F.col("length") > 0).alias("has_bytes"))


def _audit(spark, sf):
    found = audit.file_schemas(spark, sf, expected=["o_orderkey", "o_custkey"])
    return found.withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))


@query
def schema_audit(spark, sf):
    return _audit(spark, sf).select(
        "stem",
        F.array_join("columns", ",").alias("columns"),
        F.array_join("missing", ",").alias("missing"),
        F.size("extra").alias("n_extra"),
        F.col("error").isNotNull().alias("unreadable"),
    )


@query
def schema_groups(spark, sf):
    return audit.schema_summary(_audit(spark, sf)).select("schema", "n_files")


@query
def pending_inputs(spark, sf):
    """Months of each variable whose output, here every month before 1998, is not there yet."""
    months = b.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct()
    named = months.select(
        "year", "month", F.explode(F.array(*[F.lit(v) for v in PANEL_VARIABLES])).alias("variable")
    ).withColumn("stem", c.output_name("variable", "year", "month"))
    return files.pending(named, named.where(F.col("year") < 1998)).select("variable", "stem")


@query
def variable_counts(spark, sf):
    return merge.variable_counts(b.raw_long(spark, sf).where(F.col("value").isNotNull()))


@query
def read_attributes(spark, sf):
    """Customers written as CSV and read back with a stated schema."""
    folder = scratch_dir(spark, "attributes")
    customer = b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    customer.write.option("header", "true").csv(folder)
    return files.read_attributes(spark, folder, "c_custkey bigint, c_name string, c_acctbal double")


@query
def geojson_features(spark, sf):
    """Zones written as GeoJSON lines and read back as attributes."""
    return _stored_features(spark, sf, geometry=False).select(*AREA_KEYS, "n_points")


@query
def read_zones(spark, sf):
    """Zones written as GeoJSON and read back as polygons."""
    folder = scratch_dir(spark, "zones")
    geojson.write_features(_named_zones(spark, sf), folder, ["Province", "District", "Subdistric"])
    back = geojson.read_zones(spark, folder, lines=True)
    return settle(back.select(*AREA_KEYS, zone_area(F.col("rings")).alias("area")), 6)


@query
def wkt_zones(spark, sf):
    """Zones written out as WKT and read back as polygons."""
    corner = F.transform(F.col("rings")[0]["points"], lambda p: F.concat_ws(" ", p["x"], p["y"]))
    wkt = F.concat(F.lit("POLYGON (("), F.array_join(corner, ", "), F.lit("))"))
    back = geojson.zones_from_wkt(b.zones(spark, sf).select(*AREA_KEYS, wkt.alias("wkt")))
    return settle(back.select(*AREA_KEYS, zone_area(F.col("rings")).alias("area")), 6)


def _named_zones(spark, sf):
    province, district, subdistrict = AREA_KEYS
    return b.zones(spark, sf).select(
        F.col(province).alias("Province"), F.col(district).alias("District"), F.col(subdistrict).alias("Subdistric"), "rings"
    )


def _stored_features(spark, sf, geometry):
    folder = scratch_dir(spark, "features")
    counted = _named_zones(spark, sf).withColumn("n_points", F.size(F.col("rings")[0]["points"]))
    geojson.write_features(counted, folder, ["Province", "District", "Subdistric", "n_points"])
    return geojson.read_features(
        spark, folder, "Province string, District string, Subdistric string, n_points int", geometry, lines=True
    )


# --- names and scalar functions ----------------------------------------------------------------


@query
def normalize_columns(spark, sf):
    nation = b.areas(spark, sf).join(b.table(spark, sf, "customer"), F.col("nationkey") == F.col("c_nationkey"))
    messy = nation.select(
        F.col("province").alias(" Province "), F.col("district").alias("District"),
        F.col("c_mktsegment").alias("Subdistric"), F.col("c_custkey").alias("Cust Key"),
    )
    return c.normalize_columns(messy)


@query
def upper_keys(spark, sf):
    keyed = c.upper_keys(b.table(spark, sf, "documents").select("lang", "source", "n_chars"), ["lang", "source"])
    return keyed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


@query
def project_value(spark, sf):
    reduced = b.raw_cells(spark, sf).select(*PANEL_KEYS, F.col("RAINFALL").alias("sum"))
    return settle(merge.project_value(reduced, "sum", "RAINFALL"))


@query
def month_start(spark, sf):
    orders = b.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return orders.groupBy(c.month_start().alias("month_start")).agg(F.count(F.lit(1)).alias("n"))


@query
def month_label(spark, sf):
    day = F.col("o_orderdate").cast("date")
    labels = b.table(spark, sf, "orders").select(c.month_label(day).alias("label"), c.month_title(day).alias("title"))
    return labels.groupBy("label", "title").agg(F.count(F.lit(1)).alias("n"))


@query
def parse_month(spark, sf):
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyy-MM")).when(
        F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy-MM-dd")
    ).otherwise(F.col("o_orderpriority"))
    parsed = b.table(spark, sf, "orders").select(c.parse_month(text).alias("month_start"))
    return parsed.groupBy("month_start").agg(F.count(F.lit(1)).alias("n"))


@query
def output_name(spark, sf):
    orders = b.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return orders.groupBy(c.output_name(F.lit("NDVI"), "year", "month").alias("name")).agg(F.count(F.lit(1)).alias("n"))


# --- cleaning ----------------------------------------------------------------------------------


def _cleaned(spark, sf, name):
    raw = stored(b.raw_cells(spark, sf).select(*PANEL_KEYS, name), "raw")
    return settle(clean.clean_variable(raw, name, name), 6 if name in ("NDVI", "SOILMOISTURE") else 4)


@query
def clean_ndvi(spark, sf):
    return _cleaned(spark, sf, "NDVI")


@query
def clean_lst(spark, sf):
    return _cleaned(spark, sf, "LST")


@query
def clean_soilmoisture(spark, sf):
    return _cleaned(spark, sf, "SOILMOISTURE")


@query
def clean_rainfall(spark, sf):
    return _cleaned(spark, sf, "RAINFALL")


@query
def clean_firecount(spark, sf):
    return _cleaned(spark, sf, "FIRECOUNT")


@query
def iqr_filter(spark, sf):
    """Outlier mask alone, on order lines by month of shipping."""
    lines = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        F.col("l_extendedprice").alias("price"),
    )
    kept = clean.iqr_mask(lines, ["year", "month"], "price", factor=0.25)
    return settle(kept.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("price").alias("n_kept"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("kept_total"),
    ))


@query
def clean_panel(spark, sf):
    return settle(b.clean_cells(spark, sf))


@query
def monthly_quartiles(spark, sf):
    lines = b.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_extendedprice"
    )
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return settle(ranks.exact_quantiles(lines, ["year", "month"], "l_extendedprice", quartiles, keep=ranks.windows_store))


@query
def quartiles_from_state(spark, sf):
    """Quartiles by the stored sketches of two files merged: the lines are read once."""
    lines = b.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_extendedprice", "l_linenumber"
    )
    keys, late = ["year", "month"], F.col("l_linenumber") > 3
    parts = [stored(ranks.quantile_state(lines.where(p), keys, "l_extendedprice"), "state") for p in (~late, late)]
    state = ranks.merged_state(parts[0].unionByName(parts[1]), keys)
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return settle(ranks.exact_quantiles(lines, keys, "l_extendedprice", quartiles, state=state, keep=ranks.windows_store))


@query
def drop_incomplete(spark, sf):
    return settle(clean.drop_incomplete(b.merged_panel(spark, sf)))


@query
def required_columns(spark, sf):
    """What the column guard says of the raw table with one of its columns gone, for each; a whole table passes with its rows."""
    raw, needed = b.raw_long(spark, sf), ["variable", *PANEL_KEYS, "value"]
    guarded = c.require_columns(raw, needed).groupBy("variable").agg(F.count(F.lit(1)).alias("n_rows"))
    said = []
    for gone in needed:
        try:
            c.require_columns(raw.drop(gone), needed)
        except ValueError as e:
            said.append(F.lit(str(e)))
    return guarded.select("variable", "n_rows", F.explode(F.array(*said)).alias("message"))


@query
def published_tables(spark, sf):
    """Two tables published side by side, in partitions and whole, the second time with fewer rows; read back together."""
    folder, panel = scratch_dir(spark, "published"), stored(b.observed_panel(spark, sf), "panel")
    for rows in (panel, panel.where("year >= 1997")):
        files.write_table(rows, f"{folder}/panel", ["province", "year"])
        files.write_table(rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_areas")), f"{folder}/months")
    back = files.scan_partitioned(spark, f"{folder}/panel").groupBy("province", "year", "month").agg(F.sum("FIRECOUNT").alias("fires"))
    return back.join(spark.read.parquet(f"{folder}/months"), ["year", "month"]).select("province", "year", "month", "fires", "n_areas")


# --- merging -----------------------------------------------------------------------------------


@query
def merge_variables(spark, sf):
    """Outer join of the five variables, each without the rows its rules masked."""
    cleaned = stored(b.clean_cells(spark, sf).where(F.col("value").isNotNull()), "clean")
    return settle(merge.outer_merge(_parts(cleaned)))


def _parts(cleaned):
    return [merge.project_value(cleaned.where(F.col("variable") == v), "value", v) for v in PANEL_VARIABLES]


@query
def merge_variables_joined(spark, sf):
    """The same by joins, the form that lets repeated keys multiply."""
    cleaned = stored(b.clean_cells(spark, sf).where(F.col("value").isNotNull()), "clean")
    return settle(merge.outer_merge(_parts(cleaned), unique=False))


@query
def merge_long(spark, sf):
    return settle(b.merged_panel(spark, sf))


@query
def merged_sorted(spark, sf):
    return settle(b.merged_panel(spark, sf)).orderBy(*PANEL_KEYS)


@query
def concat_variable(spark, sf):
    cells = b.raw_cells(spark, sf)
    early = cells.where(F.col("year") < SPLIT_YEAR).select(*PANEL_KEYS, "FIRECOUNT")
    late = cells.where(F.col("year") >= SPLIT_YEAR).select("FIRECOUNT", *PANEL_KEYS)
    return settle(merge.concat_all([early, late]))


def _runs(spark, sf):
    """An old and a new run that overlap in 1999; the new one's values are shifted."""
    cells = stored(b.raw_cells(spark, sf).select(*PANEL_KEYS, "RAINFALL"), "runs")
    new = cells.where(F.col("year") >= SPLIT_YEAR).withColumn("RAINFALL", F.col("RAINFALL") + 1000.0)
    return cells.where(F.col("year") < SPLIT_YEAR + 1), new


@query
def upsert_keep_first(spark, sf):
    old, new = _runs(spark, sf)
    return settle(merge.upsert_keep_first(old, new, PANEL_KEYS, ["RAINFALL"]))


@query
def upsert_into_unique(spark, sf):
    old, new = _runs(spark, sf)
    return settle(merge.upsert_keep_first(old, new, PANEL_KEYS, ["RAINFALL"], old_is_unique=True))


@query
def upsert_province_month(spark, sf):
    """The two-column form: one row per month and province stays."""
    old, new = _runs(spark, sf)
    return settle(merge.upsert_keep_first(old, new, ["province", "year", "month"], ["district", "subdistrict"]))


@query
def unseen_rows(spark, sf):
    old, new = _runs(spark, sf)
    return settle(merge.unseen(new, old, PANEL_KEYS))


# --- grid and fill -----------------------------------------------------------------------------


def _merged(spark, sf):
    return stored(b.merged_panel(spark, sf), "merged")


@query
def time_bounds(spark, sf):
    bounds = fill.time_bounds(b.raw_cells(spark, sf))
    return bounds.select(
        *[c.month_start(c.year_of(F.col(x)), c.month_of(F.col(x))).alias(f"{x}_month") for x in ("first", "last")]
    )


@query
def month_grid(spark, sf):
    return settle(fill.month_grid(_merged(spark, sf)))


@query
def fill_interpolate(spark, sf):
    return settle(fill.interpolate_gaps(fill.month_grid(_merged(spark, sf))))


@query
def fill_interpolate_wide(spark, sf):
    """The same with a limit of three months."""
    return settle(fill.interpolate_gaps(fill.month_grid(_merged(spark, sf)), limit=3))


@query
def fill_climatology(spark, sf):
    return settle(fill.fill_climatology(fill.month_grid(_merged(spark, sf))))


@query
def fill_hierarchical(spark, sf):
    """Wider means alone, over a panel in which whole districts and provinces lack a variable."""
    return settle(fill.fill_hierarchical(_sparse_panel(spark, sf)))


def _sparse_panel(spark, sf):
    cells = b.raw_cells(spark, sf)
    known = {
        "NDVI": F.col("district") > "NATION_15",
        "LST": F.col("province") != "ASIA",
        "RAINFALL": (F.col("province") != "EUROPE") & (F.col("district") != "NATION_3"),
        "SOILMOISTURE": F.col("month") < 7,
        "FIRECOUNT": F.col("FIRECOUNT") > 0,
    }
    return stored(cells.select(*PANEL_KEYS, *[F.when(keep, F.col(v)).alias(v) for v, keep in known.items()]), "sparse")


@query
def fill_panel(spark, sf):
    return settle(b.filled_panel(spark, sf))


@query
def ffill_bfill(spark, sf):
    grid = fill.month_grid(_merged(spark, sf))
    return settle(fill.fill_forward_backward(grid, AREA_KEYS, ["year", "month"], PANEL_VARIABLES))


@query
def ffill_bfill_province(spark, sf):
    """The province-wide form, a group being spread over its months."""
    grid = fill.month_grid(_merged(spark, sf))
    order = ["year", "month", "district", "subdistrict"]
    return settle(fill.fill_forward_backward(grid, ["province"], order, PANEL_VARIABLES, chunk=["year", "month"]))


# --- baseline and anomaly ----------------------------------------------------------------------


@query
def year_vectors(spark, sf):
    vectors = anomaly.year_vectors(b.merged_panel(spark, sf), PANEL_VARIABLES)
    flat = [F.get(F.col(v), F.lit(m - 1)).alias(f"{v}_m{m:02d}") for v in PANEL_VARIABLES for m in anomaly.MONTHS]
    return settle(vectors.select(*AREA_KEYS, "year", "n_months", *flat))


@query
def trimmed_baseline(spark, sf):
    return settle(anomaly.trimmed_baseline(b.filled_panel(spark, sf)))


@query
def trimmed_baseline_20(spark, sf):
    """Ratio 0.2, which cuts a value at each end already for five years."""
    return settle(anomaly.trimmed_baseline(b.merged_panel(spark, sf), ratio=0.2))


@query
def trimmed_mean(spark, sf):
    """Trimmed mean of groups too large for one task."""
    lines = b.table(spark, sf, "lineitem")
    return settle(ranks.trimmed_mean(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.1, "trimmed"))


@query
def baseline_wide(spark, sf):
    return settle(anomaly.baseline_wide(b.filled_panel(spark, sf)))


def _vector_pairs(spark, sf):
    """Each area-year's temperature beside its vegetation pattern; null where one of them is not complete."""
    vectors = anomaly.year_vectors(b.filled_panel(spark, sf), ["LST", "NDVI"])
    whole = (F.col("n_months") == 12) & is_complete(F.col("LST")) & is_complete(F.col("NDVI"))
    return vectors.withColumns({v: F.when(whole, F.col(v)) for v in ("LST", "NDVI")})


@query
def dtw_distance(spark, sf):
    return settle(_vector_pairs(spark, sf).select(*AREA_KEYS, "year", dtw_column("LST", "NDVI").alias("dtw")))


@query
def dtw_distance_arrow(spark, sf):
    return settle(_vector_pairs(spark, sf).select(*AREA_KEYS, "year", dtw_arrow()("LST", "NDVI").alias("dtw")))


def _distances(spark, sf):
    return anomaly.dtw_area_years(b.filled_panel(spark, sf))


@query
def dtw_area_year(spark, sf):
    return settle(_distances(spark, sf))


@query
def dtw_local_stats(spark, sf):
    return settle(anomaly.local_stats(_distances(spark, sf)))


@query
def dtw_zscore(spark, sf):
    scored = anomaly.z_scores(anomaly.local_stats(_distances(spark, sf)))
    return settle(scored.select(*AREA_KEYS, "year", *[f"dtw_{v.lower()}_z" for v in PANEL_VARIABLES]))


@query
def dtw_zflag(spark, sf):
    flagged = anomaly.z_flags(anomaly.z_scores(anomaly.local_stats(_distances(spark, sf))))
    return flagged.select(*AREA_KEYS, "year", *[f"dtw_{v.lower()}_z_flag" for v in PANEL_VARIABLES])


@query
def dtw_local_flag(spark, sf):
    flagged = anomaly.local_flags(anomaly.local_stats(_distances(spark, sf), stats_keys=AREA_KEYS))
    kinds = ("local_threshold", "flag")
    return settle(flagged.select(*AREA_KEYS, "year", *[f"dtw_{v.lower()}_{k}" for v in PANEL_VARIABLES for k in kinds]))


@query
def composite_index(spark, sf):
    flagged = anomaly.z_flags(anomaly.z_scores(anomaly.local_stats(_distances(spark, sf))))
    return settle(anomaly.composite_index(flagged).select(*AREA_KEYS, "year", "anomaly_index", "anomaly_flags"))


@query
def dtw_anomaly(spark, sf):
    return settle(anomaly.anomaly_table(b.filled_panel(spark, sf)))


@query
def dtw_anomaly_stats(spark, sf):
    """The documented form of the table: local statistics, threshold and flag kept."""
    table = anomaly.anomaly_table(b.filled_panel(spark, sf), keep_stats=True)
    kinds = ["", "_local_mean", "_local_std", "_local_threshold", "_flag", "_z", "_z_flag"]
    return settle(table.select(*AREA_KEYS, "year", *[f"dtw_{v.lower()}{k}" for v in PANEL_VARIABLES for k in kinds]))


@query
def batch_run(spark, sf):
    """The whole batch job, every stage stored."""
    return settle(run_batch(spark, stored(b.raw_long(spark, sf), "raw"), Tables(scratch_dir(spark, "batch"))))


# --- filters and views -------------------------------------------------------------------------


@query
def filter_range(spark, sf):
    return settle(explore.filter_range(b.observed_panel(spark, sf), START, END))


@query
def filter_range_indexed(spark, sf):
    """The same from a table with a file index, which opens the files of those months only."""
    folder = scratch_dir(spark, "indexed")
    index.write_indexed(b.observed_panel(spark, sf), folder, 16, ["year", "month", "province"])
    return settle(index.read_indexed(spark, folder, index.Wanted(START, END)))


@query
def filter_area(spark, sf):
    return settle(explore.filter_area(b.observed_panel(spark, sf), district=DISTRICT))


@query
def filter_area_nested(spark, sf):
    """A district without a province is ignored, so every row stays."""
    return settle(explore.filter_area(b.observed_panel(spark, sf), district=DISTRICT, nested=True))


@query
def area_mean_subdistrict(spark, sf):
    return settle(explore.area_mean(_merged(spark, sf), "NDVI"))


@query
def area_mean_district(spark, sf):
    return settle(explore.area_mean(_merged(spark, sf), "LST", "District"))


@query
def monthly_trend(spark, sf):
    return settle(explore.monthly_trend(_merged(spark, sf), "SOILMOISTURE"))


def _map_values(spark, sf, variable, level="Subdistrict"):
    return explore.area_mean(b.observed_panel(spark, sf), variable, level)


@query
def map_summary(spark, sf):
    keys = AREA_KEYS[:2]
    on_map = explore.join_zones(b.zones(spark, sf), _map_values(spark, sf, "LST", "District"), keys)
    return settle(explore.value_range(on_map, "LST"), 2)


@query
def map_summary_by_area(spark, sf):
    """The same with zones weighted by their area."""
    on_map = explore.join_zones(zones.with_areas(b.zones(spark, sf)), _map_values(spark, sf, "LST", "District"), AREA_KEYS[:2])
    return settle(explore.value_range(on_map, "LST", weight="area"), 2)


@query
def area_extremes(spark, sf):
    return settle(explore.area_extremes(_map_values(spark, sf, "RAINFALL"), "RAINFALL"))


@query
def top_areas(spark, sf):
    return settle(explore.top_areas(_map_values(spark, sf, "RAINFALL"), "RAINFALL", 10))


@query
def kpi_row(spark, sf):
    row = explore.kpi_row(_merged(spark, sf), "RAINFALL", FIRST)
    return settle(row.withColumns({f"{x}_value": _number(f"{x}_value") for x in ("avg", "max", "min")}), 2)


@query
def distinct_months(spark, sf):
    return explore.distinct_months(b.raw_cells(spark, sf))


@query
def distinct_areas(spark, sf):
    return explore.distinct_areas(b.raw_cells(spark, sf))


@query
def district_options(spark, sf):
    options = explore.district_options(b.raw_cells(spark, sf))
    return options.select("province", F.array_join("districts", "|").alias("districts"))


@query
def slider_index(spark, sf):
    return explore.slider_index(b.raw_cells(spark, sf))


@query
def next_month(spark, sf):
    return explore.next_month(b.raw_cells(spark, sf), AS_OF)


@query
def map_frames(spark, sf):
    return settle(explore.map_frames(_merged(spark, sf), "NDVI"))


# --- zones -------------------------------------------------------------------------------------


def _areas_of(df, *more):
    return df.select(*AREA_KEYS, zone_area(F.col("rings")).alias("zone_area"), *more)


@query
def choropleth_subdistrict(spark, sf):
    joined = explore.join_zones(b.zones(spark, sf), _map_values(spark, sf, "NDVI"))
    return settle(_areas_of(joined, "NDVI"))


@query
def choropleth_district(spark, sf):
    joined = explore.join_zones(b.zones(spark, sf), _map_values(spark, sf, "LST", "District"), AREA_KEYS[:2])
    return settle(_areas_of(joined, "LST"))


@query
def to_geojson(spark, sf):
    """Zones as GeoJSON features, taken apart again by JSON path."""
    features = zones.to_geojson(b.zones(spark, sf), AREA_KEYS)
    corner = "$.geometry.coordinates[0][0][{}][{}]"
    return settle(features.select(
        F.get_json_object("value", "$.type").alias("type"),
        *[F.get_json_object("value", f"$.properties.{k}").alias(k) for k in AREA_KEYS],
        *[
            F.get_json_object("value", corner.format(i, axis)).cast("double").alias(f"{name}{i}")
            for i in (0, 2)
            for axis, name in enumerate("xy")
        ],
    ), 6)


@query
def choropleth_geojson(spark, sf):
    """The map's features: every zone with its value, null where there is none."""
    joined = explore.join_zones(b.zones(spark, sf), settle(_map_values(spark, sf, "NDVI")))
    features = zones.to_geojson(joined, [*AREA_KEYS, "NDVI"])
    return features.select(
        *[F.get_json_object("value", f"$.properties.{k}").alias(k) for k in AREA_KEYS],
        F.get_json_object("value", "$.properties.NDVI").cast("double").alias("NDVI"),
    )


@query
def zone_centroid(spark, sf):
    return settle(zones.with_areas(zones.with_centroids(b.star_zones(spark, sf))).select("zone_id", "lat", "lon", "area"), 6)


@query
def zone_simplify(spark, sf):
    """What simplified stars promise: four points a ring, every old vertex near the new line, no edges that cross."""
    stars, tolerance = b.star_zones(spark, sf), 0.01
    thin = zones.simplify_zones(stars, tolerance).select("zone_id", "rings", zone_edges(F.col("rings")).alias("thin"))
    both = thin.join(stars.select("zone_id", zone_edges(F.col("rings")).alias("old")), "zone_id")

    def near(v, e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide((v["x1"] - e["x1"]) * dx + (v["y1"] - e["y1"]) * dy, dx * dx + dy * dy)))
        return F.hypot(v["x1"] - e["x1"] - t * dx, v["y1"] - e["y1"] - t * dy) <= tolerance + 1e-12

    def side(e, x, y):
        return F.signum((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]))

    def crosses(e, f):
        return (side(e, f["x1"], f["y1"]) * side(e, f["x2"], f["y2"]) < 0) & (side(f, e["x1"], e["y1"]) * side(f, e["x2"], e["y2"]) < 0)

    return both.select(
        "zone_id",
        F.forall("rings", lambda r: F.size(r["points"]) >= 4).alias("enough"),
        F.forall("old", lambda v: F.exists("thin", lambda e: near(v, e))).alias("near"),
        (~F.exists("thin", lambda e: F.exists("thin", lambda f: crosses(e, f)))).alias("simple"),
    )


@query
def map_center(spark, sf):
    return settle(zones.map_center(b.zones(spark, sf)), 6)


@query
def map_points(spark, sf):
    return settle(zones.map_points(b.zones(spark, sf), _map_values(spark, sf, "NDVI"), "NDVI"))


@query
def simplify_shared(spark, sf):
    """What a simplified tiling promises: inner zones have no edge of their own, old vertices lie near, areas add up to the whole."""
    tiles, tolerance = b.tiling_zones(spark, sf), 0.05
    thin = stored(arcs.simplify_layer(tiles, tolerance), "thin")
    edges = thin.select("zone_id", "interior", F.explode(zone_edges(F.col("rings"))).alias("e"))
    p, q = (F.struct(F.col(f"e.x{k}").alias("x"), F.col(f"e.y{k}").alias("y")) for k in (1, 2))
    uses = edges.groupBy(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.first("e").alias("e"))
    alone = stored(uses.where("n = 1").select("a", "b", "e"), "alone")
    keyed = edges.select("zone_id", "interior", F.least(p, q).alias("a"), F.greatest(p, q).alias("b"))
    parted = keyed.join(alone, ["a", "b"], "left").groupBy("zone_id", "interior").agg(F.count("e").alias("n"))
    areas = thin.agg(F.sum(zone_area(F.col("rings"))).alias("all")).scalar()
    around = alone.agg((F.sum(F.expr("e.x1 * e.y2 - e.x2 * e.y1")) / 2).alias("area")).scalar()

    def near(v, e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide((v["x1"] - e["x1"]) * dx + (v["y1"] - e["y1"]) * dy, dx * dx + dy * dy)))
        return F.hypot(v["x1"] - e["x1"] - t * dx, v["y1"] - e["y1"] - t * dy) <= tolerance + 1e-12

    both = thin.select("zone_id", zone_edges(F.col("rings")).alias("thin")).join(tiles.select("zone_id", zone_edges(F.col("rings")).alias("old")), "zone_id")
    both = both.select(
        "zone_id", F.forall("old", lambda v: F.exists("thin", lambda e: near(v, e))).alias("near"),
        (F.size("thin") < F.size("old")).alias("fewer"), (F.size("thin") >= 3).alias("enough"),
    )
    return settle(both.join(parted, "zone_id").select(
        "zone_id", "near", "fewer", "enough", F.when(F.col("interior"), F.col("n")).alias("parted"), (areas - around).alias("area_gap")
    ), 6)


@query
def zonal_join(spark, sf):
    """Points in star-shaped zones: every zone a point lies in."""
    found = zones.zonal_join(b.points(spark, sf), b.star_zones(spark, sf), ["zone_id"])
    return found.select("point_id", "zone_id")


@query
def zonal_points(spark, sf):
    """Mean and sum of the points in each zone."""
    found = zones.zonal_join(b.points(spark, sf), b.star_zones(spark, sf), ["zone_id"])
    return settle(found.groupBy("zone_id").agg(F.avg("value").alias("mean"), F.sum("value").alias("sum"), F.count("value").alias("n")))


@query
def zone_contains_center(spark, sf):
    """Whether each star covers its own centre; a hole there takes it out."""
    stars = b.star_zones(spark, sf).join(b.points(spark, sf), F.col("zone_id") == F.col("point_id"))
    inside = covers(zone_edges(F.col("rings")), F.col("x"), F.col("y"))
    return stars.groupBy(inside.alias("inside")).agg(F.count(F.lit(1)).alias("n"))


# --- dashboard queries -------------------------------------------------------------------------


@query
def map_data(spark, sf):
    q = dashboard.MapQuery("NDVI", START, END, province=PROVINCE)
    return settle(_areas_of(dashboard.map_data(b.observed_panel(spark, sf), b.zones(spark, sf), q), "NDVI"))


#: Spans of the range means: within the panel, its start, its end and beyond, one month, all of it.
SPANS = [
    (START, END), (dt.date(1990, 1, 1), dt.date(1995, 6, 1)), (dt.date(2000, 7, 1), dt.date(2010, 1, 1)),
    (dt.date(1997, 4, 1), dt.date(1997, 4, 1)), (FIRST, dt.date(2001, 12, 1)),
]


@query
def map_data_prefix(spark, sf):
    """Area means of five spans at both levels from running totals, the last two years of which were repaired."""
    panel, folder = stored(b.observed_panel(spark, sf), "panel"), scratch_dir(spark, "prefix")
    old = panel.where("year < 2000").withColumn("NDVI", F.when(F.col("year") < 1999, F.col("NDVI")))
    prefix.write_prefix(old, folder)
    prefix.repair(panel.where("year >= 1999"), folder, 1999 * 12)
    both = [prefix.frames(spark, folder, "NDVI", SPANS, level).withColumn("subdistrict", F.col("subdistrict") if level != "District" else F.lit(None).cast("string")) for level in ("Subdistrict", "District")]
    found = both[0].unionByName(both[1].select(both[0].columns))
    return settle(found.withColumn("frame", F.col("frame").cast("int")).where("NDVI is not null"))


@query
def map_data_alias(spark, sf):
    """The same from a dashboard table: text months, names in mixed case, another name of the variable."""
    panel = b.observed_panel(spark, sf)
    table = panel.select(
        *[F.col(k).alias(k.capitalize()) for k in AREA_KEYS], c.month_label(c.month_start()).alias("year_month"),
        F.col("LST"), F.col("SOILMOISTURE").alias("SoilMoisture"), F.col("RAINFALL").alias("precipitation"),
        F.col("FIRECOUNT").alias("FireCount"), F.col("NDVI"),
    )
    q = dashboard.MapQuery("precipitation", START, END, province=PROVINCE)
    return settle(_areas_of(dashboard.map_data(dashboard.panel_of(table), b.zones(spark, sf), q), "RAINFALL"))


def _texts(df, section, label, value, digits=4):
    return df.select(F.lit(section).alias("section"), label.alias("label"), c.settled(value, digits).alias("value"))


def _number(name):
    return F.regexp_replace(F.col(name), ",", "").cast("double")


@query
def dashboard_refresh(spark, sf):
    """Map, trend and summary of one choice, one below the other."""
    q = dashboard.MapQuery("LST", START, END, level="District")
    shown = dashboard.refresh(_merged(spark, sf), b.zones(spark, sf), q)
    on_map, extremes = stored(shown.map, "on-map"), stored(shown.extremes, "extremes")
    summary = shown.summary.toDF("min", "max", "mean").unpivot([], ["min", "max", "mean"], "label", "value")
    return merge.concat_all([
        _texts(on_map, "map", c.join_names(*AREA_KEYS), F.col("LST")),
        _texts(shown.trend, "trend", c.month_label("month_start"), F.col("LST")),
        _texts(summary, "summary", F.col("label"), F.col("value"), 2),
        *[_texts(extremes, f"{x} area", F.col(f"{x}_area"), F.col(f"{x}_value")) for x in ("min", "max")],
    ])


@query
def heatmap_refresh(spark, sf):
    q = dashboard.MapQuery("RAINFALL", START, END, province=PROVINCE, level="Heatmap")
    shown = dashboard.refresh(_merged(spark, sf), b.zones(spark, sf), q).map
    return settle(shown)


@query
def kpi_dashboard(spark, sf):
    q = dashboard.MapQuery("SOILMOISTURE", START, END, province=PROVINCE, district=DISTRICT)
    view = dashboard.kpi_dashboard(_merged(spark, sf), b.zones(spark, sf), q)
    kpi = stored(view.kpi, "kpi")
    return merge.concat_all([
        _texts(kpi, "avg", F.col("observation"), _number("avg_value"), 2),
        _texts(kpi, "max", F.col("max_place"), _number("max_value"), 2),
        _texts(kpi, "min", F.col("min_place"), _number("min_value"), 2),
        _texts(view.map, "map", c.join_names(*AREA_KEYS), F.col("SOILMOISTURE")),
        _texts(view.trend, "trend", c.month_label("month_start"), F.col("SOILMOISTURE")),
    ])


@query
def static_map(spark, sf):
    joined = dashboard.static_map(b.observed_panel(spark, sf), b.zones(spark, sf), "NDVI")
    return settle(_areas_of(joined, "year", "month", "NDVI"))


# --- pixels ------------------------------------------------------------------------------------


def _images(spark, sf):
    images = b.pixel_images(spark, sf)
    return images.withColumn("FIRECOUNT", raster.fire_indicator("FireMask"))


@query
def filter_month(spark, sf):
    month = explore.filter_month(b.pixel_images(spark, sf), *IMAGE_MONTH)
    return settle(month.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.min("image_ts").cast("date").alias("first"), F.max("image_ts").cast("date").alias("last")))


@query
def select_band(spark, sf):
    """The image table in long form with all its bands, reduced to one."""
    bands = ["NDVI", "LST", "SOILMOISTURE", "RAINFALL", "FireMask"]
    images = b.pixel_images(spark, sf).withColumns({v: F.col(v).cast("double") for v in bands})
    chosen = raster.select_band(images.unpivot(["tile", "pixel", "image_ts"], bands, "band", "value"), "LST")
    return settle(chosen.groupBy("tile").agg(F.count("value").alias("n"), F.max("value").alias("top")))


@query
def fire_indicator(spark, sf):
    return _images(spark, sf).groupBy("FireMask", "FIRECOUNT").agg(F.count(F.lit(1)).alias("n"))


@query
def temporal_composite_mean(spark, sf):
    return settle(raster.composite(b.pixel_images(spark, sf), ["tile", "pixel"], {"LST": "mean", "NDVI": "mean"}))


@query
def temporal_composite_sum(spark, sf):
    return raster.composite(_images(spark, sf), ["tile", "pixel"], {"FIRECOUNT": "sum"})


def _zoned(spark, sf, bands):
    monthly = raster.composite(_images(spark, sf), ["tile", "pixel"], bands)
    return monthly.join(b.tile_zones(spark, sf), "tile")


@query
def zonal_mean(spark, sf):
    bands = {"NDVI": "mean", "LST": "mean", "SOILMOISTURE": "mean"}
    return settle(raster.zonal(_zoned(spark, sf, bands), ["province", "district"], bands))


@query
def zonal_sum(spark, sf):
    composites = _zoned(spark, sf, {"RAINFALL": "mean", "FIRECOUNT": "sum"})
    return settle(raster.zonal(composites, ["province", "district"], {"RAINFALL": "sum", "FIRECOUNT": "sum"}))


@query
def zonal_weighted(spark, sf):
    """Zonal mean with the pixel's part size as its share."""
    part = b.table(spark, sf, "part").select(F.col("p_partkey").alias("pixel"), F.col("p_size").cast("double").alias("share"))
    bands = {"LST": "mean", "RAINFALL": "sum"}
    composites = _zoned(spark, sf, {"LST": "mean", "RAINFALL": "mean"}).join(part, "pixel")
    return settle(raster.zonal(composites, ["province", "district"], bands, weight="share"))


@query
def zonal_fire_sum(spark, sf):
    """Fire count by the one-shuffle path: both its reducers are sums."""
    lines = _images(spark, sf).join(b.tile_zones(spark, sf), "tile")
    return raster.zonal_month_sum(lines, ["province", "district"], "FIRECOUNT")


@query
def zonal_monthly(spark, sf):
    tiles = b.tile_zones(spark, sf)
    return settle(raster.zonal_monthly(
        _images(spark, sf), ["tile", "pixel"], ["province", "district"], lambda m: m.join(tiles, "tile"), list(VARIABLES.values())
    ))


@query
def zonal_monthly_polygons(spark, sf):
    """The export table by polygon: a part's pixel lies where the vector of its number points.

    Zones are found once per pixel; the composites follow by pixel key.
    """
    places = zones.zonal_join(b.points(spark, sf), b.star_zones(spark, sf), ["zone_id"])
    placed = places.select(F.col("point_id").alias("pixel"), "zone_id")
    return settle(raster.zonal_monthly(
        _images(spark, sf), ["pixel"], ["zone_id"], lambda m: m.join(placed, "pixel"), list(VARIABLES.values())
    ))


#: Width and height of the pixels around the vectors' points.
PIXEL = (0.02, 0.03)


def _shares(spark, sf):
    return shares.pixel_shares(b.points(spark, sf), b.star_zones(spark, sf), ["zone_id"], ["point_id"], *PIXEL)


@query
def pixel_shares(spark, sf):
    """How much of each pixel lies in each star it touches."""
    return settle(_shares(spark, sf), 6)


@query
def zonal_weighted_polygons(spark, sf):
    """The export table by polygon, each pixel counted by the share of it that lies in the zone."""
    placed = stored(_shares(spark, sf), "shares")
    bands = {v.name: v.reducer for v in VARIABLES.values()}
    monthly = raster.composite(_images(spark, sf), ["pixel"], {v.name: v.composite for v in VARIABLES.values()})
    places, met = (df.withColumnRenamed("point_id", "pixel") for df in (b.points(spark, sf), placed))
    shared = shares.gathered(monthly, met, places, ["pixel"], ["zone_id"], list(bands), (2 * PIXEL[0], 2 * PIXEL[1]))
    return settle(raster.zonal(shared, ["zone_id"], bands, weight={v: f"{v}_share" for v in bands}))


# --- streams -----------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    """Raw cells arriving as files in three batches, the last repeating the first; ingested twice."""
    source, target = scratch_dir(spark, "arriving"), scratch_dir(spark, "ingested")
    raw = stored(b.raw_long(spark, sf), "raw")
    again = raw.withColumn("value", F.col("value") + 1000.0)
    for part in (raw.where(F.col("year") < 1998), raw.where(F.col("year") >= 1998), again.where(F.col("year") < 1998)):
        part.write.mode("append").parquet(source)
        ingest.ingest(spark, source, raw.schema, target, f"{target}-checkpoint")
    return settle(files.scan_partitioned(spark, target).select("variable", *PANEL_KEYS, "value"))


@query
def stream_release(spark, sf):
    """Ingested rows of the months before the running one, outliers masked as in the batch job."""
    source, target = scratch_dir(spark, "arriving"), scratch_dir(spark, "ingested")
    raw = b.raw_long(spark, sf)
    raw.write.parquet(source)
    ingest.ingest(spark, source, raw.schema, target, f"{target}-checkpoint")
    released = ingest.release_months(files.scan_partitioned(spark, target), 2000, 7)
    return settle(released.select("variable", *PANEL_KEYS, "value"))


@query
def incremental_run(spark, sf):
    """Two ticks of the incremental job, the second with later files and a later date."""
    source, tables = scratch_dir(spark, "arriving"), Tables(scratch_dir(spark, "incremental"))
    raw = stored(b.raw_long(spark, sf), "raw")
    raw.where(F.col("year") < SPLIT_YEAR).write.parquet(source)
    incremental.run_tick(spark, source, raw.schema, tables, dt.date(SPLIT_YEAR, 1, 15))
    raw.where(F.col("year") >= SPLIT_YEAR).write.mode("append").parquet(source)
    return settle(incremental.run_tick(spark, source, raw.schema, tables, dt.date(2001, 3, 10)))


def _event_stream(spark, sf):
    schema = b.table(spark, sf, "events").schema
    return ingest.new_files(spark, sf, schema, "events.parquet").select("ts", "event_type", "value")


@query
def stream_daily(spark, sf):
    """Days of the event stream that are closed after one run."""
    target = scratch_dir(spark, "daily")
    days = windows.daily_zonal(_event_stream(spark, sf), ["event_type"], "value")
    windows.append_available(days, target, f"{target}-checkpoint")
    return settle(spark.read.parquet(target))


@query
def stream_monthly_from_daily(spark, sf):
    target = scratch_dir(spark, "daily")
    # the month of events is stretched to four
    stretched = F.expr("TIMESTAMP_NTZ'2024-01-01' + (ts - TIMESTAMP_NTZ'2024-01-01') * 4")
    days = windows.daily_zonal(_event_stream(spark, sf).withColumn("ts", stretched), ["event_type"], "value")
    windows.append_available(days, target, f"{target}-checkpoint")
    return settle(windows.monthly_from_daily(spark.read.parquet(target), ["event_type"]))


@query
def stream_closed_months(spark, sf):
    """Order totals of every month but the running one."""
    target = scratch_dir(spark, "months")
    schema = b.table(spark, sf, "orders").schema
    orders = ingest.new_files(spark, sf, schema, "orders.parquet").select("o_orderdate", "o_orderpriority", "o_totalprice")
    found = windows.closed_months(orders, ["o_orderpriority"], "o_totalprice", grace_months=0, ts="o_orderdate")
    windows.append_available(found, target, f"{target}-checkpoint")
    return settle(spark.read.parquet(target), 2)


def _backlog(spark, sf, grace_months):
    """Orders arriving as files in four runs of a stream, out of order: 1997, 1995 and 1996, 1998, the rest.

    Each run is a restart from the checkpoint. Returns the folder of the stream's output and its schema.
    """
    source, folder = scratch_dir(spark, "arriving"), scratch_dir(spark, "months")
    orders = b.table(spark, sf, "orders").select("o_orderdate", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)"))
    year = F.year("o_orderdate")
    for part in (year == 1997, year < 1997, year == 1998, year > 1998):
        orders.where(part).write.mode("append").parquet(source)
        arrived = ingest.new_files(spark, source, orders.schema)
        found = months.open_months(arrived, ["o_orderpriority"], "o_totalprice", grace_months, "o_orderdate")
        months.run_months(found, folder, f"{folder}-checkpoint")
    return folder, found.schema


@query
def stream_backlog_months(spark, sf):
    """An out-of-order backlog within the grace gives the totals of the batch form."""
    found = months.closed(spark, *_backlog(spark, sf, 36)).drop("n_rows")
    return settle(found.withColumn("sum", F.col("sum").cast("double")), 2)


@query
def stream_late_rows(spark, sf):
    """With less grace the rows behind it are counted as late, and no month is partly closed with them."""
    found = months.late(spark, *_backlog(spark, sf, 3), ["o_orderpriority"])
    return settle(found.withColumn("sum", F.col("sum").cast("double")), 2)


@query
def incremental_late_variable(spark, sf):
    """Fire counts arrive a tick after the other variables of their months and complete the rows."""
    source, tables = scratch_dir(spark, "arriving"), Tables(scratch_dir(spark, "incremental"))
    raw = stored(b.raw_long(spark, sf), "raw")
    late = F.col("variable") == "FIRECOUNT"
    raw.where(~late).write.parquet(source)
    incremental.run_tick(spark, source, raw.schema, tables, dt.date(2001, 3, 10))
    raw.where(late).write.mode("append").parquet(source)
    incremental.run_tick(spark, source, raw.schema, tables, dt.date(2001, 3, 10))
    return settle(spark.read.parquet(tables.merged).select(*PANEL_KEYS, *PANEL_VARIABLES))


@query
def ingest_null_then_value(spark, sf):
    """Every cell arrives three times: without a value, with a masked value, and good; the good one enters."""
    source, target = scratch_dir(spark, "arriving"), scratch_dir(spark, "ingested")
    raw = stored(b.raw_long(spark, sf), "raw")
    good = F.when(F.col("variable").isin("RAINFALL", "FIRECOUNT"), F.abs("value")).otherwise(F.col("value"))
    for value in (F.lit(None).cast("double"), F.lit(-99999.0), good):
        raw.withColumn("value", value).write.mode("append").parquet(source)
        ingest.ingest(spark, source, raw.schema, target, f"{target}-checkpoint")
    return settle(files.scan_partitioned(spark, target).select("variable", *PANEL_KEYS, "value"))


def _ticks(spark, sf, parts):
    """The versions after each tick, the raw rows arriving part by part."""
    source, root = scratch_dir(spark, "arriving"), scratch_dir(spark, "ticks")
    raw = stored(b.raw_long(spark, sf), "raw")
    versions = []
    for part in parts:
        raw.where(part).write.mode("append").parquet(source)
        versions.append(ticks.run_tick(spark, source, raw.schema, root, dt.date(2001, 3, 10)))
    return root, versions


@query
def incremental_fill(spark, sf):
    """Five ticks: months in order, a gap, late months that close it, new months, a late variable. Equal to one fill."""
    year, fire = F.col("year"), F.col("variable") == "FIRECOUNT"
    parts = [(year < 1997) & ~fire, year == 1998, (year == 1997) & ~fire, (year > 1998) & ~fire, (year != 1998) & fire]
    root, versions = _ticks(spark, sf, parts)
    return settle(ticks.filled_panel(spark, root, versions[-1]))


@query
def incremental_pinned(spark, sf):
    """A version taken after the second tick, read after two more that came between and after its months."""
    year = F.col("year")
    root, versions = _ticks(spark, sf, [year < 1997, year == 1998, year == 1997, year > 1998])
    return settle(ticks.merged_panel(spark, root, versions[1]).select(*PANEL_KEYS, *PANEL_VARIABLES))


@query
def batch_rerun(spark, sf):
    """The batch job over all rows and then over the years before 2000: the second run leaves nothing of the first."""
    tables = Tables(scratch_dir(spark, "batch"))
    raw = stored(b.raw_long(spark, sf), "raw")
    run_batch(spark, raw, tables)
    run_batch(spark, raw.where((F.col("year") < 2000) & (F.col("variable") != "FIRECOUNT")), tables)
    return settle(files.scan_partitioned(spark, tables.clean).select("variable", *PANEL_KEYS, "value"))
