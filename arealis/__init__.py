"""Areal time-series and anomaly engine expressed as Spark DataFrame transformations."""

from arealis.registry import AREA_KEYS, PANEL_KEYS, PANEL_VARIABLES, TIME_KEYS

__all__ = ["AREA_KEYS", "PANEL_KEYS", "PANEL_VARIABLES", "TIME_KEYS"]
