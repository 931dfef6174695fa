"""Time fill and scoring on a made-up panel of realistic size, beside a plain pandas program of the same definitions.

python measure.py [areas] [pandas areas]: Spark runs over all areas, pandas over a few, scaled up. Prints seconds.
"""

from __future__ import annotations

import sys
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from arealis.operators.anomaly import anomaly_table
from arealis.operators.fill import fill_panel, seasonal_store
from arealis.registry import AREA_KEYS, PANEL_VARIABLES, TRIM_RATIO
from arealis.session import local_session, stored

MONTHS, FIRST_YEAR = 132, 2015


def made_up(spark, areas: int):
    """Areas x months with a quarter of the values missing."""
    cells = spark.range(areas).withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(MONTHS - 1))))
    noise = lambda v: F.pmod(F.xxhash64("id", "m", F.lit(v)), F.lit(1000)) / 1000
    value = lambda v: F.when(noise(v + "?") >= 0.25, F.sin(F.col("m") * 0.5236) + noise(v))
    names = {"province": F.col("id") % 77, "district": F.col("id") % 900, "subdistrict": F.col("id")}
    return cells.select(
        *[F.concat(F.lit(k[0]), c.cast("string")).alias(k) for k, c in names.items()],
        (FIRST_YEAR + F.floor(F.col("m") / 12)).cast("int").alias("year"), (F.col("m") % 12 + 1).cast("int").alias("month"),
        *[value(v).alias(v) for v in PANEL_VARIABLES],
    )


def pandas_fill(panel: pd.DataFrame) -> pd.DataFrame:
    out = panel.sort_values([*AREA_KEYS, "year", "month"]).copy()
    for v in PANEL_VARIABLES:
        out[v] = out.groupby(AREA_KEYS)[v].transform(lambda x: x.interpolate(limit=1))
        for level in ([*AREA_KEYS, "month"], AREA_KEYS[:2], AREA_KEYS[:1]):
            out[v] = out[v].fillna(out.groupby(level)[v].transform("mean"))
        out[v] = out[v].fillna(out[v].mean())
    return out


def pandas_distances(panel: pd.DataFrame) -> list[float]:
    """Trimmed baseline of each area and the warping distance of each of its years."""
    found = []
    for _, area in panel.groupby(AREA_KEYS):
        for v in PANEL_VARIABLES:
            years = area.pivot_table(index="year", columns="month", values=v).to_numpy()
            cut = int(len(years) * TRIM_RATIO)
            base = np.sort(years, axis=0)[cut : len(years) - cut].mean(axis=0)
            for y in years:
                best = np.full((len(y) + 1, len(base) + 1), np.inf)
                best[0, 0] = 0
                for i, a in enumerate(y):
                    for j, b in enumerate(base):
                        best[i + 1, j + 1] = abs(a - b) + min(best[i, j], best[i, j + 1], best[i + 1, j])
                found.append(best[-1, -1])
    return found


def main() -> None:
    areas, few = (int(x) for x in (*sys.argv[1:], *["7400", "100"][len(sys.argv) - 1 :]))
    spark = local_session("8", "arealis-measure")
    panel = stored(made_up(spark, areas), "panel")
    small = panel.where(F.substring("subdistrict", 2, 9).cast("int") < few).toPandas()

    def timed(label: str, run, scale: float = 1.0):
        start = time.perf_counter()
        out = run()
        print(f"{label}: {(time.perf_counter() - start) * scale:.1f} s", flush=True)
        return out

    filled = timed("pandas fill, scaled up", lambda: pandas_fill(small), areas / few)
    timed("pandas scoring, scaled up", lambda: pandas_distances(filled), areas / few)
    kept = timed("Spark fill", lambda: stored(fill_panel(panel, keep=seasonal_store), "filled"))
    timed("Spark scoring", lambda: anomaly_table(kept).write.format("noop").mode("overwrite").save())


if __name__ == "__main__":
    main()
