"""Variables, keys and constants the results depend on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

AREA_KEYS = ["province", "district", "subdistrict"]
TIME_KEYS = ["year", "month"]
PANEL_KEYS = AREA_KEYS + TIME_KEYS
PANEL_VARIABLES = ["NDVI", "LST", "RAINFALL", "SOILMOISTURE", "FIRECOUNT"]

# Fixed values.
MONTHS_PER_YEAR = 12
INTERPOLATION_LIMIT = 1
IQR_FACTOR = 1.5
TRIM_RATIO = 0.1
Z_THRESHOLD = 2.0
LOCAL_SIGMAS = 2.0
FIRE_MASK_MIN = 7
SIMPLIFY_TOLERANCE = 0.001
SLIDER_STEP = 12


@dataclass(frozen=True)
class Variable:
    """How one variable is observed, reduced to areas and cleaned."""

    name: str
    collection: str
    band: str
    scale_m: int
    composite: str
    reducer: str
    low: float
    high: float | None = None
    sentinel: float | None = None
    iqr: bool = False
    rescale: Callable[[Column], Column] | None = None


# Source collections, bands, reducers, value ranges.
VARIABLES = {
    v.name: v
    for v in [
        Variable("NDVI", "MODIS/061/MOD13Q1", "NDVI", 250, "mean", "mean",
                 low=-0.2, high=1.0, sentinel=0.0, iqr=True, rescale=lambda v: v / 10000),
        Variable("LST", "MODIS/061/MOD11A2", "LST_Day_1km", 1000, "mean", "mean",
                 low=5.0, high=55.0, iqr=True, rescale=lambda v: v * 0.02 - 273.15),
        Variable("SOILMOISTURE", "NASA/SMAP/SPL4SMGP/007", "sm_surface", 10000, "mean", "mean",
                 low=0.0, high=1.0, iqr=True),
        Variable("RAINFALL", "UCSB-CHG/CHIRPS/DAILY", "precipitation", 10000, "mean", "sum", low=0.0),
        Variable("FIRECOUNT", "MODIS/061/MOD14A1", "FireMask", 1000, "sum", "sum", low=0.0),
    ]
}

# Other spellings of the variable names, by upper-cased form.
VARIABLE_ALIASES = {
    "PRECIPITATION": "RAINFALL",
    "SOIL_MOISTURE": "SOILMOISTURE",
    "SOIL MOISTURE": "SOILMOISTURE",
}

# Level name -> grouping keys of the map query.
MAP_LEVELS = {
    "Subdistrict": AREA_KEYS,
    "Heatmap": AREA_KEYS,
    "District": ["province", "district"],
}


def canonical_variable(name: str) -> str:
    """Upper-case a variable name and resolve its alias."""
    upper = name.strip().upper()
    return VARIABLE_ALIASES.get(upper, upper)


def map_level_keys(level: str) -> list[str]:
    """Grouping keys of a map level; an unknown level means subdistrict."""
    return MAP_LEVELS.get(level, AREA_KEYS)
