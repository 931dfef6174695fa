"""The catalog's queries as DuckDB SQL, written from the definitions rather than from the Spark plans."""

from __future__ import annotations

from arealis.plans.binding import STAR
from arealis.registry import PANEL_VARIABLES as VARS

AREA = "province, district, subdistrict"
KEY = f"{AREA}, year, month"
IQR_VARS = ("NDVI", "LST", "SOILMOISTURE")
RANGE = "year * 12 + month BETWEEN 1996 * 12 + 3 AND 1999 * 12 + 8"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def rnd(x: str, digits: int = 4) -> str:
    return f"(floor(({x})::DOUBLE * 1e{digits}::DOUBLE + 0.5003::DOUBLE) / 1e{digits}::DOUBLE)"


def rounded(names, digits: int = 4) -> str:
    return ", ".join(f"{rnd(n, digits)} AS {n}" for n in names)


# a segment is divided, so that areas grow with the customers
SUBDISTRICT = "c_mktsegment || ' ' || (c_custkey // 1000)::VARCHAR"

CELLS = f"""cells AS (
  SELECT r_name AS province, n_name AS district, {SUBDISTRICT} AS subdistrict,
         year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
         sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE / 45 AS NDVI,
         sum(l_quantity::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE * 65 + 13500 AS LST,
         sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS RAINFALL,
         sum(l_discount::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE * 12 AS SOILMOISTURE,
         count(*) FILTER (WHERE l_linenumber >= 7)::DOUBLE AS FIRECOUNT
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)"""

RAW = "raw AS (" + " UNION ALL ".join(f"SELECT '{v}' AS variable, {KEY}, {v} AS v FROM cells" for v in VARS) + ")"

RAW_GOOD = RAW.replace("raw AS (", "raw AS (SELECT variable, province, district, subdistrict, year, month, CASE WHEN variable IN ('RAINFALL', 'FIRECOUNT') THEN abs(v) ELSE v END AS v FROM (", 1) + ")"

MASKED = f"""scaled AS (
  SELECT variable, {KEY}, CASE variable WHEN 'NDVI' THEN v / 10000 WHEN 'LST' THEN v * 0.02::DOUBLE - 273.15::DOUBLE ELSE v END AS v
  FROM raw), masked AS (
  SELECT variable, {KEY}, CASE
    WHEN variable = 'NDVI' AND v BETWEEN -0.2 AND 1.0 AND v <> 0 THEN v
    WHEN variable = 'LST' AND v BETWEEN 5 AND 55 THEN v
    WHEN variable = 'SOILMOISTURE' AND v BETWEEN 0 AND 1 THEN v
    WHEN variable IN ('RAINFALL', 'FIRECOUNT') AND v >= 0 THEN v END AS v
  FROM scaled)"""

CLEAN = f"""bounds AS (
  SELECT variable, year, month, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
  FROM masked WHERE variable IN {IQR_VARS} GROUP BY ALL), clean AS (
  SELECT variable, {KEY}, CASE WHEN variable NOT IN {IQR_VARS}
    OR (v >= q1 - 1.5::DOUBLE * (q3 - q1) AND v <= q3 + 1.5::DOUBLE * (q3 - q1)) THEN v END AS v
  FROM masked LEFT JOIN bounds USING (variable, year, month))"""

MERGED = "merged AS (SELECT " + KEY + ", " + ", ".join(
    f"max(v) FILTER (WHERE variable = '{v}') AS {v}" for v in VARS
) + " FROM clean GROUP BY ALL)"


def grid(source: str) -> str:
    return f"""grid AS (
  SELECT a.province, a.district, a.subdistrict, (m // 12)::INTEGER AS year, (m % 12 + 1)::INTEGER AS month, {', '.join(VARS)}
  FROM (SELECT DISTINCT {AREA} FROM {source}) a
  CROSS JOIN (SELECT unnest(range(min(year * 12 + month - 1), max(year * 12 + month))) AS m FROM {source}) g
  LEFT JOIN {source} p ON p.province = a.province AND p.district = a.district AND p.subdistrict = a.subdistrict
       AND p.year * 12 + p.month - 1 = g.m)"""


def interpolated(limit: int) -> str:
    before = f"(PARTITION BY {AREA} ORDER BY year, month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = f"(PARTITION BY {AREA} ORDER BY year, month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    near, filled = [], []
    for v in VARS:
        at = f"CASE WHEN {v} IS NOT NULL THEN year * 12 + month END"
        near += [
            f"last_value({v} IGNORE NULLS) OVER {before} AS p_{v}", f"last_value({at} IGNORE NULLS) OVER {before} AS pi_{v}",
            f"first_value({v} IGNORE NULLS) OVER {after} AS n_{v}", f"first_value({at} IGNORE NULLS) OVER {after} AS ni_{v}",
        ]
        gap = f"(year * 12 + month - pi_{v})"
        filled.append(
            f"CASE WHEN {v} IS NOT NULL THEN {v} WHEN {gap} > {limit} THEN NULL WHEN n_{v} IS NULL THEN p_{v} "
            f"ELSE p_{v} + (n_{v} - p_{v}) / (ni_{v} - pi_{v}) * {gap} END AS {v}"
        )
    return f"near AS (SELECT *, {', '.join(near)} FROM grid), interp AS (SELECT {KEY}, {', '.join(filled)} FROM near)"


def mean_fill(name: str, source: str, partition: str) -> str:
    over = f"OVER (PARTITION BY {partition})" if partition else "OVER ()"
    cols = ", ".join(f"coalesce({v}, avg({v}) {over}) AS {v}" for v in VARS)
    return f"{name} AS (SELECT {KEY}, {cols} FROM {source})"


def hierarchy(source: str) -> str:
    return ", ".join([
        mean_fill("by_district", source, "province, district"),
        mean_fill("by_province", "by_district", "province"),
        mean_fill("filled", "by_province", ""),
    ])


CLIM = mean_fill("seasonal", "interp", f"{AREA}, month")
WITH_RAW = f"WITH {CELLS}, {RAW}"
WITH_CLEAN = f"{WITH_RAW}, {MASKED}, {CLEAN}"
# read by several joins: evaluated once
WITH_CLEAN_ONCE = WITH_CLEAN.replace("clean AS (", "clean AS MATERIALIZED (").replace("cells AS (", "cells AS MATERIALIZED (")
WITH_MERGED = f"{WITH_CLEAN}, {MERGED}"
WITH_GRID = f"{WITH_MERGED}, {grid('merged')}"
WITH_FILLED = f"{WITH_GRID}, {interpolated(1)}, {CLIM}, {hierarchy('seasonal')}"


def long_of(source: str, name: str) -> str:
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT {KEY}, '{v}' AS variable, {v} AS v FROM {source}" for v in VARS
    ) + ")"


def baseline(source: str, ratio: float) -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {AREA}, month, variable ORDER BY v) AS rn,
         count(*) OVER (PARTITION BY {AREA}, month, variable) AS n FROM {source} WHERE v IS NOT NULL), base AS (
  SELECT {AREA}, month, variable, avg(v) AS b FROM ranked
  WHERE rn > floor({ratio}::DOUBLE * n) AND rn <= n - floor({ratio}::DOUBLE * n) GROUP BY ALL)"""


def dtw(x: str, y: str) -> str:
    """Nested folds over one-element lists: the outer one carries a row of the cost table."""
    inner = (
        f"list_reduce(list_concat([['inf'::DOUBLE]], list_transform(range(1, len({y}) + 1), lambda k: [k::DOUBLE])), "
        f"lambda a, k: list_append(a, abs(r[1] - {y}[k[1]::INTEGER]) + least(a[-1], d[k[1]::INTEGER + 1], d[k[1]::INTEGER])))"
    )
    start = f"[list_concat([0::DOUBLE], list_transform({y}, lambda k: 'inf'::DOUBLE))]"
    whole = f"list_reduce(list_concat({start}, list_transform({x}, lambda k: [k])), lambda d, r: {inner})[-1]"
    return f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {whole} END"


YEARS = f"""xs AS (
  SELECT {AREA}, year, variable, list(v ORDER BY month) AS x FROM flong
  GROUP BY ALL HAVING count(*) = 12 AND count(v) = 12), ys AS (
  SELECT {AREA}, variable, list(b ORDER BY month) AS y FROM base GROUP BY ALL HAVING count(b) = 12), dist AS (
  SELECT k.province, k.district, k.subdistrict, k.year, k.variable, {dtw('x', 'y')} AS d
  FROM (SELECT DISTINCT {AREA}, year, variable FROM flong) k
  LEFT JOIN xs ON xs.province = k.province AND xs.district = k.district AND xs.subdistrict = k.subdistrict
       AND xs.year = k.year AND xs.variable = k.variable
  LEFT JOIN ys ON ys.province = k.province AND ys.district = k.district AND ys.subdistrict = k.subdistrict
       AND ys.variable = k.variable)"""


def scored(partition: str = "district, subdistrict") -> str:
    w = f"OVER (PARTITION BY {partition}, variable)"
    return f"""stats AS (SELECT *, avg(d) {w} AS mu, stddev_samp(d) {w} AS sd FROM dist), scored AS (
  SELECT *, CASE WHEN sd > abs(mu) * 1e-12 THEN (d - mu) / sd END AS z FROM stats), flagged AS (
  SELECT *, CASE WHEN z > 2.0 THEN 1 ELSE 0 END AS zf, mu + 2 * sd AS thr,
         CASE WHEN d > mu + 2 * sd THEN 1 ELSE 0 END AS lf FROM scored)"""


WITH_BASE = f"{WITH_FILLED}, {long_of('filled', 'flong')}, {baseline('flong', 0.1)}"
WITH_DIST = f"{WITH_BASE}, {YEARS}"
WITH_SCORES = f"{WITH_DIST}, {scored()}"


def per_variable(columns: dict[str, str], digits: int = 4) -> str:
    """Wide columns ``dtw_<variable><suffix>`` out of long rows; integer columns stay unrounded."""
    out = []
    for v in VARS:
        for suffix, x in columns.items():
            pick = f"max({x}) FILTER (WHERE variable = '{v}')"
            out.append(f"{pick + '::INTEGER' if suffix.endswith('flag') else rnd(pick, digits)} AS dtw_{v.lower()}{suffix}")
    return ", ".join(out)


def scores(columns: dict[str, str], with_: str = WITH_SCORES) -> str:
    return f"{with_} SELECT {AREA}, year, {per_variable(columns)} FROM flagged GROUP BY {AREA}, year"


BASE_COLUMNS = ", ".join(
    f"{rnd(f'''max(b) FILTER (WHERE variable = '{v}' AND month = {m})''')} AS baseline_{v.lower()}_m{m:02d}"
    for v in VARS for m in range(1, 13)
)

ANOMALY = f"""{WITH_SCORES}, wide AS (
  SELECT {AREA}, year, {per_variable({'': 'd', '_z': 'z', '_z_flag': 'zf'})} FROM flagged GROUP BY {AREA}, year), bw AS (
  SELECT {AREA}, {BASE_COLUMNS} FROM base GROUP BY {AREA})
SELECT * FROM wide JOIN bw USING ({AREA})"""

AREAS = "areas AS (SELECT n_nationkey AS nk, r_name AS province, n_name AS district FROM nation JOIN region ON n_regionkey = r_regionkey)"

ZONES = f"""{AREAS}, extent AS (
  SELECT nk, sub, min(bal) AS lo, max(bal) AS hi, count(*) AS n FROM (
    SELECT c_nationkey AS nk, {SUBDISTRICT} AS sub, c_acctbal AS bal FROM customer
    UNION ALL SELECT s_nationkey, 'SUPPLIERS', s_acctbal FROM supplier) GROUP BY ALL), zones AS (
  SELECT province, district, sub AS subdistrict, lo / 1000 AS x0, hi / 1000 + 1 AS x1, nk::DOUBLE AS y0, nk::DOUBLE + n / 100 AS y1,
         ((hi / 1000 + 1) - lo / 1000) * ((nk::DOUBLE + n / 100) - nk::DOUBLE) AS zone_area
  FROM extent JOIN areas USING (nk))"""

_SCALE = "(SELECT sqrt(500.0::DOUBLE / count(*)) FROM embeddings)"
_vertex_x = [f"embedding[1]::DOUBLE + (abs(embedding[{i + 3}]::DOUBLE) * 0.3::DOUBLE + 0.02::DOUBLE) * {_SCALE} * ({ux}::DOUBLE)" for i, (ux, _) in enumerate(STAR)]
_vertex_y = [f"embedding[2]::DOUBLE + (abs(embedding[{i + 3}]::DOUBLE) * 0.3::DOUBLE + 0.02::DOUBLE) * {_SCALE} * ({uy}::DOUBLE)" for i, (_, uy) in enumerate(STAR)]
_square = [(-1, -1), (1, -1), (1, 1), (-1, 1)]
_hole_x = [f"embedding[1]::DOUBLE + ({dx}) * (0.005::DOUBLE * {_SCALE})" for dx, _ in _square]
_hole_y = [f"embedding[2]::DOUBLE + ({dy}) * (0.005::DOUBLE * {_SCALE})" for _, dy in _square]


def _corner_rows(xs: list[str], ys: list[str], hole: bool) -> str:
    return " UNION ALL ".join(
        f"SELECT vec_id AS zone_id, {hole} AS hole, {x} AS x1, {y} AS y1, {xn} AS x2, {yn} AS y2 FROM embeddings"
        + (" WHERE vec_id % 4 = 0" if hole else "")
        for x, y, xn, yn in zip(xs, ys, xs[1:] + xs[:1], ys[1:] + ys[:1])
    )


EDGES = f"edges AS ({_corner_rows(_vertex_x, _vertex_y, False)} UNION ALL {_corner_rows(_hole_x, _hole_y, True)})"
POINTS = "points AS (SELECT vec_id AS point_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label::DOUBLE AS value FROM embeddings)"
HITS = """hits AS (
  SELECT point_id, zone_id, value FROM points JOIN edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
  GROUP BY ALL HAVING count(*) % 2 = 1)"""
# The area under each edge inside the pixel, integrated along x: the y of the edge is held between the pixel's lower and upper side.
SHARES = """turned AS (
  SELECT edges.*, sign(r.a) * CASE WHEN edges.hole THEN -1 ELSE 1 END AS s
  FROM edges JOIN (SELECT zone_id, hole, sum(x1 * y2 - x2 * y1) AS a FROM edges GROUP BY ALL) r USING (zone_id, hole)), pixels AS (
  SELECT point_id, x - 0.01::DOUBLE AS l, x + 0.01::DOUBLE AS r, y - 0.015::DOUBLE AS d, y + 0.015::DOUBLE AS u FROM points), cut AS (
  SELECT *, least(greatest(x1, l), r) AS xa, least(greatest(x2, l), r) AS xb, (y2 - y1) / (x2 - x1) AS m
  FROM pixels JOIN turned ON greatest(x1, x2) > l AND least(x1, x2) < r AND greatest(y1, y2) > d AND x1 <> x2), ends AS (
  SELECT *, y1 + m * (xa - x1) AS ya, y1 + m * (xb - x1) AS yb FROM cut), passes AS (
  SELECT *, CASE WHEN ya = yb THEN 0 ELSE least(greatest((d - ya) / (yb - ya), 0), 1) END AS t0,
         CASE WHEN ya = yb THEN 0 ELSE least(greatest((u - ya) / (yb - ya), 0), 1) END AS t1 FROM ends), means AS (
  SELECT *, least(t0, t1) AS e, greatest(t0, t1) AS f FROM passes), shares AS (
  SELECT point_id, zone_id, -sum(s * (xb - xa) * (
    e * least(greatest(ya, d), u) + (1 - f) * least(greatest(yb, d), u)
    + (f - e) * (least(greatest(ya + e * (yb - ya), d), u) + least(greatest(ya + f * (yb - ya), d), u)) / 2 - d)) / (0.02::DOUBLE * 0.03::DOUBLE) AS share
  FROM means GROUP BY ALL HAVING share > 1e-12)"""
CENTROIDS = """rings AS (
  SELECT zone_id, hole, sum(x1 * y2 - x2 * y1) AS a, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS mx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS my
  FROM edges GROUP BY ALL), centers AS (
  SELECT zone_id, sum(CASE WHEN hole THEN -1 ELSE 1 END * sign(a) * a) AS a, sum(CASE WHEN hole THEN -1 ELSE 1 END * sign(a) * mx) AS mx,
         sum(CASE WHEN hole THEN -1 ELSE 1 END * sign(a) * my) AS my FROM rings GROUP BY ALL)"""

IMAGES = """images AS (
  SELECT l_suppkey AS tile, l_partkey AS pixel, l_shipdate AS ts, year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month,
         l_extendedprice / 10 AS NDVI, l_quantity * 65 + 13500 AS LST, l_discount * 12 AS SOILMOISTURE, l_tax * 100 AS RAINFALL,
         l_linenumber AS FireMask, CASE WHEN l_linenumber >= 7 THEN 1 ELSE 0 END AS FIRECOUNT FROM lineitem)"""
COMPOSITE = """comp AS (
  SELECT tile, pixel, year, month, avg(NDVI) AS NDVI, avg(LST) AS LST, avg(SOILMOISTURE) AS SOILMOISTURE, avg(RAINFALL) AS RAINFALL,
         sum(FIRECOUNT) AS FIRECOUNT FROM images GROUP BY ALL)"""
SUMMED = ("RAINFALL", "FIRECOUNT")
PIXEL_MONTH = ", ".join(f"{'sum' if v == 'FIRECOUNT' else 'avg'}({v}) AS {v}" for v in VARS)
ZONE_MONTH = ", ".join(f"{'sum' if v in SUMMED else 'avg'}({v})::DOUBLE AS {v}" for v in VARS)
TILES = f"{AREAS}, tiles AS (SELECT s_suppkey AS tile, province, district FROM supplier JOIN areas ON s_nationkey = nk)"
ZONAL = """zonal AS (
  SELECT province, district, year, month, avg(NDVI) AS NDVI, avg(LST) AS LST, avg(SOILMOISTURE) AS SOILMOISTURE,
         sum(RAINFALL) AS RAINFALL, sum(FIRECOUNT)::BIGINT AS FIRECOUNT FROM comp JOIN tiles USING (tile) GROUP BY ALL)"""
WITH_ZONAL = f"WITH {IMAGES}, {COMPOSITE}, {TILES}, {ZONAL}"


def cleaned(v: str) -> str:
    return f"{WITH_CLEAN} SELECT {KEY}, {rnd('v', 6 if v in ('NDVI', 'SOILMOISTURE') else 4)} AS {v} FROM clean WHERE variable = '{v}'"


def panel(with_: str, source: str, where: str = "") -> str:
    return f"{with_} SELECT {KEY}, {rounded(VARS)} FROM {source}" + (f" WHERE {where}" if where else "")


def means(v: str, keys: str = AREA, source: str = "cells", where: str = "TRUE") -> str:
    return f"means AS (SELECT {keys}, avg({v}) AS {v} FROM {source} WHERE {where} GROUP BY {keys})"


def directional_fill(group: str, order: str, with_: str = WITH_GRID) -> str:
    up = f"(PARTITION BY {group} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = f"(PARTITION BY {group} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    cols = [f"coalesce(last_value({v} IGNORE NULLS) OVER {up}, first_value({v} IGNORE NULLS) OVER {down}) AS {v}" for v in VARS]
    return f"{with_}, f AS (SELECT {KEY}, {', '.join(cols)} FROM grid) SELECT {KEY}, {rounded(VARS)} FROM f"


def upsert(keys: str, order: str) -> str:
    return f"""WITH {CELLS}, runs AS (
  SELECT 0 AS src, {KEY}, RAINFALL FROM cells WHERE year < 2000
  UNION ALL SELECT 1, {KEY}, RAINFALL + 1000 FROM cells WHERE year >= 1999), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY src, {order}) AS rn FROM runs)
SELECT {KEY}, {rnd('RAINFALL')} AS RAINFALL FROM ranked WHERE rn = 1"""


SPARSE = f"""sparse AS (
  SELECT {KEY}, CASE WHEN district > 'NATION_15' THEN NDVI END AS NDVI, CASE WHEN province <> 'ASIA' THEN LST END AS LST,
         CASE WHEN province <> 'EUROPE' AND district <> 'NATION_3' THEN RAINFALL END AS RAINFALL,
         CASE WHEN month < 7 THEN SOILMOISTURE END AS SOILMOISTURE, CASE WHEN FIRECOUNT > 0 THEN FIRECOUNT END AS FIRECOUNT FROM cells)"""

LINES = "lines AS (SELECT year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month, l_extendedprice AS price FROM lineitem)"
ORDER_MONTHS = "months AS (SELECT DISTINCT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month FROM orders)"
PLACE = "concat_ws(', ', province, district, subdistrict)"
MONTH_DATE = "make_date(year, month, 1)"
LABEL = "strftime(make_date(year, month, 1), '%Y-%m')"


def extremes(v: str, digits: int = 4) -> str:
    """One row with the least and greatest mean and their areas, ties by key."""
    low = f"(SELECT {{0}} FROM means WHERE {v} IS NOT NULL ORDER BY {v}, {AREA} LIMIT 1)"
    high = f"(SELECT {{0}} FROM means WHERE {v} IS NOT NULL ORDER BY {v} DESC, {AREA} LIMIT 1)"
    return (
        f"SELECT {rnd(low.format(v), digits)} AS min_value, {low.format(PLACE)} AS min_area, "
        f"{rnd(high.format(v), digits)} AS max_value, {high.format(PLACE)} AS max_area"
    )


def kpi(v: str) -> dict[str, str]:
    order = "subdistrict, district, province"
    low = f"(SELECT {{0}} FROM means WHERE {v} IS NOT NULL ORDER BY {v}, {order} LIMIT 1)"
    high = f"(SELECT {{0}} FROM means WHERE {v} IS NOT NULL ORDER BY {v} DESC, {order} LIMIT 1)"
    place = "concat_ws(', ', subdistrict, district)"
    return {
        "avg_value": _shown(f"(SELECT avg({v}) FROM means)"),
        "max_value": _shown(high.format(v)), "max_place": high.format(place),
        "min_value": _shown(low.format(v)), "min_place": low.format(place),
    }


def _shown(x: str, digits: int = 4) -> str:
    """A displayed number: plain rounding, then two digits that survive another order of addition."""
    return rnd(f"round({x}, {digits})", 2)


def section(name: str, label: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS section, {label} AS label, {rnd(value)} AS value FROM {source}"


_kpi_rain, _kpi_soil = kpi("RAINFALL"), kpi("SOILMOISTURE")
DISTRICT_MEANS = means("LST", "province, district")

STREAM_CLOSED = """WITH w AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events), days AS (
  SELECT CAST(ts AS DATE) AS day, event_type, sum(value) AS s, avg(value) AS m, count(value) AS n FROM events
  GROUP BY 1, 2), closed AS (SELECT * FROM days WHERE day + INTERVAL 1 DAY <= (SELECT mark FROM w))"""

STRETCHED = "WITH stretched AS (SELECT * REPLACE (TIMESTAMP '2024-01-01' + (ts - TIMESTAMP '2024-01-01') * 4 AS ts) FROM events)"

# months before the running one, without cells that never had a value
MASKED_LATER = MASKED.replace("masked AS", "masked_later AS").replace("scaled", "scaled_later").replace("FROM raw", "FROM later")
ARRIVED = f"""grid AS (SELECT * FROM merged WHERE year * 12 + month < 2001 * 12 + 3
  AND ({KEY}) IN (SELECT ({KEY}) FROM masked WHERE v IS NOT NULL))"""

DESCRIBED = "described AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS stem, array_to_string(list(column_name), ',') AS columns, list(column_name) AS names FROM (DESCRIBE SELECT * FROM {t})"
    for t in TABLES.split()
) + ")"

ORACLE: dict[str, str] = {
    "scan_panel": f"SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n_rows, {rnd('sum(o_totalprice::DECIMAL(18,2))')} AS total FROM orders GROUP BY 1",
    "variable_from_path": f"{WITH_RAW} SELECT variable, {KEY}, {rnd('v')} AS value FROM raw",
    "list_inputs": " UNION ALL ".join(f"SELECT '{t}' AS stem, count(*) > 0 AS has_bytes FROM {t}" for t in TABLES.split()),
    "schema_audit": f"WITH {DESCRIBED} SELECT stem, columns, concat_ws(',', CASE WHEN NOT list_contains(names, 'o_orderkey') THEN 'o_orderkey' END, CASE WHEN NOT list_contains(names, 'o_custkey') THEN 'o_custkey' END) AS missing, len(list_filter(names, lambda c: c NOT IN ('o_orderkey', 'o_custkey')))::INTEGER AS n_extra, false AS unreadable FROM described",
    "schema_groups": f"WITH {DESCRIBED} SELECT array_to_string(list_sort(names), ',') AS schema, count(*) AS n_files FROM described GROUP BY 1",
    "pending_inputs": f"WITH {ORDER_MONTHS}, vars AS (SELECT unnest({VARS}) AS variable) SELECT variable, format('{{}}_{{}}_{{:02d}}', variable, year, month) AS stem FROM months CROSS JOIN vars WHERE year >= 1998",
    "variable_counts": f"{WITH_RAW} SELECT variable, count(*) AS n_rows FROM raw WHERE v IS NOT NULL GROUP BY 1",
    "read_attributes": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "geojson_features": f"WITH {ZONES} SELECT {AREA}, 5::INTEGER AS n_points FROM zones",
    "read_zones": f"WITH {ZONES} SELECT {AREA}, {rnd('zone_area', 6)} AS area FROM zones",
    "wkt_zones": f"WITH {ZONES} SELECT {AREA}, {rnd('zone_area', 6)} AS area FROM zones",
    "normalize_columns": "SELECT r_name AS province, n_name AS district, c_mktsegment AS subdistrict, c_custkey AS cust_key FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "upper_keys": "SELECT upper(lang) AS lang, upper(source) AS source, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY ALL",
    "project_value": f"WITH {CELLS} SELECT {KEY}, {rnd('RAINFALL')} AS RAINFALL FROM cells",
    "month_start": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS n FROM orders GROUP BY 1",
    "month_label": "SELECT strftime(o_orderdate, '%Y-%m') AS label, strftime(o_orderdate, '%b %Y') AS title, count(*) AS n FROM orders GROUP BY ALL",
    "parse_month": "SELECT CASE WHEN o_orderkey % 3 < 2 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month_start, count(*) AS n FROM orders GROUP BY 1",
    "output_name": "SELECT 'NDVI_' || strftime(o_orderdate, '%Y_%m') AS name, count(*) AS n FROM orders GROUP BY 1",
    "clean_ndvi": cleaned("NDVI"),
    "clean_lst": cleaned("LST"),
    "clean_soilmoisture": cleaned("SOILMOISTURE"),
    "clean_rainfall": cleaned("RAINFALL"),
    "clean_firecount": cleaned("FIRECOUNT"),
    "iqr_filter": f"""WITH {LINES}, q AS (SELECT year, month, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM lines GROUP BY ALL),
kept AS (SELECT year, month, CASE WHEN price >= q1 - 0.25::DOUBLE * (q3 - q1) AND price <= q3 + 0.25::DOUBLE * (q3 - q1) THEN price END AS price FROM lines JOIN q USING (year, month))
SELECT year, month, count(*) AS n_rows, count(price) AS n_kept, {rnd('sum(price::DECIMAL(18,2))')} AS kept_total FROM kept GROUP BY ALL""",
    "clean_panel": f"{WITH_CLEAN} SELECT variable, {KEY}, {rnd('v')} AS value FROM clean",
    "monthly_quartiles": f"WITH {LINES} SELECT year, month, {rnd('quantile_cont(price, 0.25)')} AS q1, {rnd('quantile_cont(price, 0.5)')} AS median, {rnd('quantile_cont(price, 0.75)')} AS q3 FROM lines GROUP BY year, month",
    "quartiles_from_state": f"WITH {LINES} SELECT year, month, {rnd('quantile_cont(price, 0.25)')} AS q1, {rnd('quantile_cont(price, 0.5)')} AS median, {rnd('quantile_cont(price, 0.75)')} AS q3 FROM lines GROUP BY year, month",
    "required_columns": f"{WITH_RAW} SELECT variable, count(*) AS n_rows, 'Missing required columns: [''' || gone || ''']' AS message "
    "FROM raw, (SELECT unnest(['variable', 'province', 'district', 'subdistrict', 'year', 'month', 'value']) AS gone) GROUP BY ALL",
    "published_tables": f"WITH {CELLS}, m AS (SELECT year, month, count(*) AS n_areas FROM cells WHERE year >= 1997 GROUP BY ALL) "
    "SELECT province, year, month, sum(FIRECOUNT) AS fires, n_areas FROM cells JOIN m USING (year, month) GROUP BY ALL",
    "drop_incomplete": panel(WITH_MERGED, "merged", " AND ".join(f"{v} IS NOT NULL" for v in VARS)),
    "merge_variables": f"{WITH_CLEAN_ONCE}, "
    + ", ".join(f"t_{v} AS (SELECT {KEY}, v AS {v} FROM clean WHERE variable = '{v}' AND v IS NOT NULL)" for v in VARS)
    + f" SELECT {KEY}, {rounded(VARS)} FROM t_{VARS[0]} "
    + " ".join(f"FULL JOIN t_{v} USING ({KEY})" for v in VARS[1:]),
    "merge_long": panel(WITH_MERGED, "merged"),
    "merged_sorted": panel(WITH_MERGED, "merged") + f" ORDER BY {KEY}",
    "concat_variable": f"WITH {CELLS} SELECT {KEY}, {rnd('FIRECOUNT')} AS FIRECOUNT FROM cells",
    "upsert_keep_first": upsert(KEY, "RAINFALL"),
    "upsert_province_month": upsert("province, year, month", "district, subdistrict"),
    "unseen_rows": f"WITH {CELLS} SELECT {KEY}, {rnd('RAINFALL + 1000')} AS RAINFALL FROM cells WHERE year >= 2000",
    "time_bounds": "SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first_month, CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS last_month FROM orders SEMI JOIN lineitem ON o_orderkey = l_orderkey",
    "month_grid": panel(WITH_GRID, "grid"),
    "fill_interpolate": panel(f"{WITH_GRID}, {interpolated(1)}", "interp"),
    "fill_interpolate_wide": panel(f"{WITH_GRID}, {interpolated(3)}", "interp"),
    "fill_climatology": panel(f"{WITH_GRID}, {mean_fill('seasonal', 'grid', AREA + ', month')}", "seasonal"),
    "fill_hierarchical": panel(f"WITH {CELLS}, {SPARSE}, {hierarchy('sparse')}", "filled"),
    "fill_panel": panel(WITH_FILLED, "filled"),
    "ffill_bfill": directional_fill(AREA, "year, month"),
    "ffill_bfill_province": directional_fill("province", "year, month, district, subdistrict"),
    "year_vectors": f"{WITH_MERGED} SELECT {AREA}, year, count(*) AS n_months, "
    + ", ".join(f"{rnd(f'max({v}) FILTER (WHERE month = {m})')} AS {v}_m{m:02d}" for v in VARS for m in range(1, 13))
    + f" FROM merged GROUP BY {AREA}, year",
    "trimmed_baseline": f"{WITH_BASE}, area_months AS (SELECT * FROM (SELECT DISTINCT {AREA} FROM filled) CROSS JOIN (SELECT unnest(range(1, 13))::INTEGER AS month)) SELECT {AREA}, month, "
    + ", ".join(f"{rnd(f'''max(b) FILTER (WHERE variable = '{v}')''')} AS {v}" for v in VARS)
    + f" FROM area_months LEFT JOIN base USING ({AREA}, month) GROUP BY {AREA}, month",
    "trimmed_baseline_20": f"{WITH_MERGED}, {long_of('merged', 'mlong')}, {baseline('mlong', 0.2)}, area_months AS (SELECT * FROM (SELECT DISTINCT {AREA} FROM merged) CROSS JOIN (SELECT unnest(range(1, 13))::INTEGER AS month)) SELECT {AREA}, month, "
    + ", ".join(f"{rnd(f'''max(b) FILTER (WHERE variable = '{v}')''')} AS {v}" for v in VARS)
    + f" FROM area_months LEFT JOIN base USING ({AREA}, month) GROUP BY {AREA}, month",
    "trimmed_mean": f"""WITH r AS (SELECT l_returnflag, l_linestatus, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) AS rn,
count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n FROM lineitem)
SELECT l_returnflag, l_linestatus, {rnd('sum(v::DECIMAL(18,2))::DOUBLE / count(*)')} AS trimmed FROM r WHERE rn > floor(0.1::DOUBLE * n) AND rn <= n - floor(0.1::DOUBLE * n) GROUP BY l_returnflag, l_linestatus""",
    "baseline_wide": f"{WITH_BASE} SELECT {AREA}, {BASE_COLUMNS} FROM base GROUP BY {AREA}",
    "dtw_distance": f"{WITH_FILLED}, v AS (SELECT {AREA}, year, list(LST ORDER BY month) AS x, list(NDVI ORDER BY month) AS y, count(*) = 12 AND count(LST) = 12 AND count(NDVI) = 12 AS whole FROM filled GROUP BY ALL), w AS (SELECT {AREA}, year, {rnd(dtw('x', 'y'))} AS dtw FROM v WHERE whole) SELECT {AREA}, year, dtw FROM v LEFT JOIN w USING ({AREA}, year)",
    "dtw_area_year": scores({"": "d"}),
    "dtw_local_stats": scores({"": "d", "_local_mean": "mu", "_local_std": "sd"}),
    "dtw_zscore": scores({"_z": "z"}),
    "dtw_zflag": scores({"_z_flag": "zf"}),
    "dtw_local_flag": scores({"_local_threshold": "thr", "_flag": "lf"}, f"{WITH_DIST}, {scored(AREA)}"),
    "composite_index": f"{WITH_SCORES} SELECT {AREA}, year, {rnd('avg(z)')} AS anomaly_index, sum(zf)::INTEGER AS anomaly_flags FROM flagged GROUP BY {AREA}, year",
    "dtw_anomaly": ANOMALY,
    "batch_run": ANOMALY,
    "dtw_anomaly_stats": scores({"": "d", "_local_mean": "mu", "_local_std": "sd", "_local_threshold": "thr", "_flag": "lf", "_z": "z", "_z_flag": "zf"}),
    "filter_range": panel(f"WITH {CELLS}", "cells", RANGE),
    "filter_range_indexed": panel(f"WITH {CELLS}", "cells", RANGE),
    "filter_area": panel(f"WITH {CELLS}", "cells", "district = 'NATION_2'"),
    "filter_area_nested": panel(f"WITH {CELLS}", "cells"),
    "area_mean_subdistrict": f"{WITH_MERGED}, {means('NDVI', source='merged')} SELECT {AREA}, {rnd('NDVI')} AS NDVI FROM means",
    "area_mean_district": f"{WITH_MERGED}, {means('LST', 'province, district', 'merged')} SELECT province, district, {rnd('LST')} AS LST FROM means",
    "monthly_trend": f"{WITH_MERGED} SELECT {MONTH_DATE} AS month_start, {rnd('avg(SOILMOISTURE)')} AS SOILMOISTURE FROM merged GROUP BY year, month",
    "map_summary": f"WITH {CELLS}, {ZONES}, {DISTRICT_MEANS} SELECT {_shown('min(LST)', 3)} AS min_value, {_shown('max(LST)', 3)} AS max_value, {_shown('avg(LST)', 3)} AS mean_value FROM zones LEFT JOIN means USING (province, district)",
    "area_extremes": f"WITH {CELLS}, {means('RAINFALL')} {extremes('RAINFALL')}",
    "top_areas": f"WITH {CELLS}, {means('RAINFALL')} SELECT {AREA}, {rnd('RAINFALL')} AS RAINFALL FROM means ORDER BY means.RAINFALL DESC, {AREA} LIMIT 10",
    "kpi_row": f"{WITH_MERGED}, {means('RAINFALL', source='merged')} SELECT {_kpi_rain['avg_value']} AS avg_value, {_kpi_rain['max_value']} AS max_value, {_kpi_rain['max_place']} AS max_place, {_kpi_rain['min_value']} AS min_value, {_kpi_rain['min_place']} AS min_place, 'Jan 1995' AS observation",
    "distinct_months": f"WITH {CELLS} SELECT DISTINCT {MONTH_DATE} AS month_start FROM cells",
    "distinct_areas": f"WITH {CELLS} SELECT DISTINCT {AREA} FROM cells",
    "district_options": f"WITH {CELLS} SELECT province, string_agg(district, '|' ORDER BY district) AS districts FROM (SELECT DISTINCT province, district FROM cells) GROUP BY province",
    "slider_index": f"WITH {CELLS}, m AS (SELECT DISTINCT {LABEL} AS month_label FROM cells), i AS (SELECT (row_number() OVER (ORDER BY month_label) - 1)::INTEGER AS position, month_label, count(*) OVER () AS n FROM m) SELECT position, month_label, CASE WHEN position % 12 = 0 OR position = n - 1 THEN month_label ELSE '' END AS tick_label FROM i",
    "next_month": f"WITH {CELLS}, l AS (SELECT max(make_date(year, month, 1)) + INTERVAL 1 MONTH AS d FROM cells) SELECT year(d)::INTEGER AS year, month(d)::INTEGER AS month FROM l WHERE d < DATE '2002-06-01'",
    "map_frames": f"{WITH_MERGED}, m AS (SELECT year, month, (row_number() OVER (ORDER BY year, month) - 1)::INTEGER AS frame, count(*) OVER ()::INTEGER AS n FROM (SELECT DISTINCT year, month FROM merged)) SELECT frame, ((frame + 1) % n)::INTEGER AS next_frame, {MONTH_DATE} AS month_start, {AREA}, {rnd('avg(NDVI)')} AS NDVI FROM merged JOIN m USING (year, month) GROUP BY frame, n, year, month, {AREA}",
    "choropleth_subdistrict": f"WITH {CELLS}, {ZONES}, {means('NDVI')} SELECT {AREA}, {rnd('zone_area')} AS zone_area, {rnd('NDVI')} AS NDVI FROM zones LEFT JOIN means USING ({AREA})",
    "choropleth_district": f"WITH {CELLS}, {ZONES}, {DISTRICT_MEANS} SELECT {AREA}, {rnd('zone_area')} AS zone_area, {rnd('LST')} AS LST FROM zones LEFT JOIN means USING (province, district)",
    "zone_centroid": f"WITH {EDGES}, {CENTROIDS} SELECT zone_id, {rnd('my / (3 * a)', 6)} AS lat, {rnd('mx / (3 * a)', 6)} AS lon, {rnd('a / 2', 6)} AS area FROM centers",
    "map_center": f"WITH {ZONES} SELECT {rnd('avg((y0 + y1) / 2)', 6)} AS lat, {rnd('avg((x0 + x1) / 2)', 6)} AS lon FROM zones",
    "to_geojson": f"WITH {ZONES} SELECT 'Feature' AS type, {AREA}, {rnd('x0', 6)} AS x0, {rnd('y0', 6)} AS y0, {rnd('x1', 6)} AS x2, {rnd('y1', 6)} AS y2 FROM zones",
    "choropleth_geojson": f"WITH {CELLS}, {ZONES}, {means('NDVI')} SELECT {AREA}, {rnd('NDVI')} AS NDVI FROM zones LEFT JOIN means USING ({AREA})",
    "map_summary_by_area": f"WITH {CELLS}, {ZONES}, {DISTRICT_MEANS} SELECT {_shown('min(LST)', 3)} AS min_value, {_shown('max(LST)', 3)} AS max_value, {_shown('sum(LST * zone_area) / sum(zone_area)', 3)} AS mean_value FROM zones JOIN means USING (province, district) WHERE LST IS NOT NULL",
    "map_points": f"WITH {CELLS}, {ZONES}, {means('NDVI')} SELECT {AREA}, {rnd('(y0 + y1) / 2')} AS lat, {rnd('(x0 + x1) / 2')} AS lon, {rnd('NDVI')} AS NDVI FROM zones JOIN means USING ({AREA}) WHERE NDVI IS NOT NULL AND zone_area > 0",
    "zone_simplify": "SELECT vec_id AS zone_id, TRUE AS enough, TRUE AS near, TRUE AS simple FROM embeddings",
    "simplify_shared": "WITH s AS (SELECT floor(sqrt(count(*)))::BIGINT AS side FROM embeddings) "
    "SELECT vec_id AS zone_id, TRUE AS near, TRUE AS fewer, TRUE AS enough, 0::DOUBLE AS area_gap, "
    "CASE WHEN vec_id % side > 0 AND vec_id // side > 0 AND vec_id % side < side - 2 AND vec_id // side < side - 2 THEN 0::BIGINT END AS parted "
    "FROM embeddings, s WHERE vec_id < side * side AND vec_id % side < side - 1 AND vec_id // side < side - 1",
    "zonal_join": f"WITH {EDGES}, {POINTS}, {HITS} SELECT point_id, zone_id FROM hits",
    "zonal_points": f"WITH {EDGES}, {POINTS}, {HITS} SELECT zone_id, {rnd('avg(value)')} AS mean, {rnd('sum(value)')} AS sum, count(value) AS n FROM hits GROUP BY zone_id",
    "zone_contains_center": f"WITH {EDGES}, {POINTS}, {HITS} SELECT hits.zone_id IS NOT NULL AS inside, count(*) AS n FROM points LEFT JOIN hits ON hits.point_id = points.point_id AND hits.zone_id = points.point_id GROUP BY 1",
    "map_data_prefix": f"WITH {CELLS}, spans(frame, a, b) AS (VALUES (0, 1996 * 12 + 3, 1999 * 12 + 8), (1, 1990 * 12 + 1, 1995 * 12 + 6), "
    "(2, 2000 * 12 + 7, 2010 * 12 + 1), (3, 1997 * 12 + 4, 1997 * 12 + 4), (4, 1995 * 12 + 1, 2001 * 12 + 12)), "
    "inside AS (SELECT * FROM cells JOIN spans ON year * 12 + month BETWEEN a AND b) "
    f"SELECT frame::INTEGER AS frame, province, district, subdistrict, {rnd('avg(NDVI)')} AS NDVI FROM inside GROUP BY ALL HAVING count(NDVI) > 0 "
    f"UNION ALL SELECT frame::INTEGER, province, district, NULL, {rnd('avg(NDVI)')} FROM inside GROUP BY ALL HAVING count(NDVI) > 0",
    "map_data": f"WITH {CELLS}, {ZONES}, {means('NDVI', where=RANGE + chr(32) + 'AND province = ' + chr(39) + 'ASIA' + chr(39))} SELECT {AREA}, {rnd('zone_area')} AS zone_area, {rnd('NDVI')} AS NDVI FROM zones LEFT JOIN means USING ({AREA})",
    "map_data_alias": f"WITH {CELLS}, {ZONES}, {means('RAINFALL', where=RANGE + chr(32) + 'AND province = ' + chr(39) + 'ASIA' + chr(39))} SELECT {AREA}, {rnd('zone_area')} AS zone_area, {rnd('RAINFALL')} AS RAINFALL FROM zones LEFT JOIN means USING ({AREA})",
    "dashboard_refresh": f"""{WITH_MERGED}, {ZONES}, {means('LST', 'province, district', 'merged', RANGE)}, shown AS (
  SELECT zones.*, LST FROM zones LEFT JOIN means USING (province, district)), lo AS (
  SELECT * FROM means WHERE LST IS NOT NULL ORDER BY LST, province, district LIMIT 1), hi AS (
  SELECT * FROM means WHERE LST IS NOT NULL ORDER BY LST DESC, province, district LIMIT 1)
{section('map', PLACE, 'LST', 'shown')}
UNION ALL {section('trend', LABEL, 'avg(LST)', 'merged')} WHERE {RANGE} GROUP BY year, month
UNION ALL SELECT 'summary', 'min', {_shown('min(LST)', 3)} FROM shown
UNION ALL SELECT 'summary', 'max', {_shown('max(LST)', 3)} FROM shown
UNION ALL SELECT 'summary', 'mean', {_shown('avg(LST)', 3)} FROM shown
UNION ALL {section('min area', "concat_ws(', ', province, district)", 'LST', 'lo')}
UNION ALL {section('max area', "concat_ws(', ', province, district)", 'LST', 'hi')}""",
    "heatmap_refresh": f"{WITH_MERGED}, {ZONES}, {means('RAINFALL', source='merged', where=RANGE)} SELECT {AREA}, {rnd('(y0 + y1) / 2')} AS lat, {rnd('(x0 + x1) / 2')} AS lon, {rnd('RAINFALL')} AS RAINFALL FROM zones JOIN means USING ({AREA}) WHERE province = 'ASIA' AND RAINFALL IS NOT NULL AND zone_area > 0",
    "kpi_dashboard": f"""{WITH_MERGED}, {ZONES}, sel AS (SELECT * FROM merged WHERE {RANGE} AND province = 'ASIA' AND district = 'NATION_2'),
{means('SOILMOISTURE', source='sel')}, one AS (SELECT 1)
SELECT 'avg' AS section, 'Mar 1996' AS label, {_kpi_soil['avg_value']} AS value
UNION ALL SELECT 'max', {_kpi_soil['max_place']}, {_kpi_soil['max_value']}
UNION ALL SELECT 'min', {_kpi_soil['min_place']}, {_kpi_soil['min_value']}
UNION ALL {section('map', PLACE, 'SOILMOISTURE', f'(SELECT * FROM zones LEFT JOIN means USING ({AREA}))')}
UNION ALL {section('trend', LABEL, 'avg(SOILMOISTURE)', 'sel')} GROUP BY year, month""",
    "static_map": f"WITH {CELLS}, {ZONES} SELECT {AREA}, {rnd('zone_area')} AS zone_area, year, month, {rnd('NDVI')} AS NDVI FROM zones LEFT JOIN cells USING ({AREA})",
    "filter_month": "SELECT l_suppkey AS tile, count(*) AS n, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 5 GROUP BY 1",
    "select_band": f"SELECT l_suppkey AS tile, count(*) AS n, {rnd('max(l_quantity * 65 + 13500)')} AS top FROM lineitem GROUP BY 1",
    "fire_indicator": f"WITH {IMAGES} SELECT FireMask, FIRECOUNT, count(*) AS n FROM images GROUP BY ALL",
    "temporal_composite_mean": f"WITH {IMAGES}, {COMPOSITE} SELECT tile, pixel, year, month, {rnd('LST')} AS LST, {rnd('NDVI')} AS NDVI FROM comp",
    "temporal_composite_sum": f"WITH {IMAGES}, {COMPOSITE} SELECT tile, pixel, year, month, FIRECOUNT::BIGINT AS FIRECOUNT FROM comp",
    "zonal_mean": f"{WITH_ZONAL} SELECT province, district, year, month, {rounded(['NDVI', 'LST', 'SOILMOISTURE'])} FROM zonal",
    "zonal_sum": f"{WITH_ZONAL} SELECT province, district, year, month, {rnd('RAINFALL')} AS RAINFALL, FIRECOUNT FROM zonal",
    "zonal_weighted": f"WITH {IMAGES}, {COMPOSITE}, {TILES} SELECT province, district, year, month, {rnd('sum(LST * p_size) / sum(p_size)')} AS LST, {rnd('sum(RAINFALL * p_size)')} AS RAINFALL FROM comp JOIN tiles USING (tile) JOIN part ON p_partkey = pixel GROUP BY province, district, year, month",
    "zonal_fire_sum": f"{WITH_ZONAL} SELECT province, district, year, month, FIRECOUNT FROM zonal",
    "zonal_monthly": f"{WITH_ZONAL} " + " UNION ALL ".join(
        f"SELECT province, district, year, month, '{v}' AS variable, {rnd(v) if v in IQR_VARS else 'NULL::DOUBLE'} AS mean, {rnd(v) if v not in IQR_VARS else 'NULL::DOUBLE'} AS sum FROM zonal"
        for v in VARS
    ),
    "pixel_shares": f"WITH {EDGES}, {POINTS}, {SHARES} SELECT point_id, zone_id, {rnd('share', 6)} AS share FROM shares",
    "zonal_weighted_polygons": f"WITH {IMAGES}, {EDGES}, {POINTS}, {SHARES}, comp AS (SELECT pixel, year, month, {PIXEL_MONTH} FROM images GROUP BY ALL) "
    "SELECT zone_id, year, month, "
    + ", ".join(rnd(f"sum({v} * share)" + ("" if v in SUMMED else " / sum(share)")) + f" AS {v}" for v in VARS)
    + " FROM comp JOIN shares ON pixel = point_id GROUP BY zone_id, year, month",
    "zonal_monthly_polygons": f"WITH {IMAGES}, {EDGES}, {POINTS}, {HITS}, comp AS (SELECT pixel, year, month, {PIXEL_MONTH} FROM images GROUP BY ALL), "
    f"z AS (SELECT zone_id, year, month, {ZONE_MONTH} FROM comp JOIN hits ON pixel = point_id GROUP BY ALL) "
    + " UNION ALL ".join(
        f"SELECT zone_id, year, month, '{v}' AS variable, {'NULL::DOUBLE' if v in SUMMED else rnd(v)} AS mean, {rnd(v) if v in SUMMED else 'NULL::DOUBLE'} AS sum FROM z"
        for v in VARS
    ),
    # a later file only brings what had no value before
    "stream_ingest": f"{WITH_RAW}, {MASKED}, later AS (SELECT variable, {KEY}, v + 1000 AS v FROM raw WHERE year < 1998), {MASKED_LATER} SELECT variable, {KEY}, {rnd('v')} AS value FROM masked WHERE v IS NOT NULL UNION ALL SELECT variable, {KEY}, {rnd('v')} FROM masked_later ANTI JOIN (SELECT * FROM masked WHERE v IS NOT NULL) AS m USING (variable, {KEY}) WHERE v IS NOT NULL",
    "stream_release": f"{WITH_CLEAN} SELECT variable, {KEY}, {rnd('v')} AS value FROM clean SEMI JOIN (SELECT * FROM masked WHERE v IS NOT NULL) AS m USING (variable, {KEY}) WHERE year * 12 + month < 2000 * 12 + 7",
    "incremental_run": directional_fill(AREA, "year, month", f"{WITH_MERGED}, {ARRIVED}"),
    "incremental_late_variable": f"{WITH_MERGED}, {ARRIVED} SELECT {KEY}, {rounded(VARS)} FROM grid",
    "incremental_fill": directional_fill(AREA, "year, month", f"{WITH_MERGED}, {ARRIVED}"),
    "incremental_pinned": f"{WITH_MERGED}, {ARRIVED} SELECT {KEY}, {rounded(VARS)} FROM grid WHERE year < 1997 OR year = 1998",
    "ingest_null_then_value": f"WITH {CELLS}, {RAW_GOOD}, {MASKED} SELECT variable, {KEY}, {rnd('v')} AS value FROM masked WHERE v IS NOT NULL",
    "batch_rerun": f"{WITH_CLEAN} SELECT variable, {KEY}, {rnd('v')} AS value FROM clean WHERE year < 2000 AND variable <> 'FIRECOUNT'",
    "stream_backlog_months": "SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, o_orderpriority, " + rnd("sum(o_totalprice::DECIMAL(18,2))", 2) + " AS sum, count(*) AS n FROM orders WHERE year(o_orderdate) * 12 + month(o_orderdate) < (SELECT max(year(o_orderdate) * 12 + month(o_orderdate)) - 36 FROM orders) GROUP BY ALL",
    "stream_late_rows": "SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, o_orderpriority, " + rnd("sum(o_totalprice::DECIMAL(18,2))", 2) + " AS sum, count(*) AS n_rows FROM orders WHERE year(o_orderdate) < 1997 AND year(o_orderdate) * 12 + month(o_orderdate) < (SELECT max(year(o_orderdate) * 12 + month(o_orderdate)) - 3 FROM orders WHERE year(o_orderdate) = 1997) GROUP BY ALL",
    "stream_daily": f"{STREAM_CLOSED} SELECT day, event_type, {rnd('s')} AS sum, {rnd('m')} AS mean, n FROM closed",
    "stream_monthly_from_daily": f"{STRETCHED} SELECT event_type, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, {rnd('sum(value)')} AS sum, count(value) AS n, {rnd('avg(value)')} AS mean FROM stretched WHERE last_day(ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM stretched) GROUP BY ALL",
    "stream_closed_months": f"SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, o_orderpriority, {rnd('sum(o_totalprice)', 2)} AS sum, count(o_totalprice) AS n FROM orders GROUP BY ALL HAVING max(date_trunc('month', o_orderdate)) < (SELECT date_trunc('month', max(o_orderdate)) FROM orders)",
}
ORACLE["dtw_distance_arrow"] = ORACLE["dtw_distance"]
ORACLE["upsert_into_unique"] = ORACLE["upsert_keep_first"]
ORACLE["merge_variables_joined"] = ORACLE["merge_variables"]
