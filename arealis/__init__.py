"""Event-and-area analytics on Spark: clean, join, rate, describe, correlate, regress."""

from arealis.levels import DISTRICT, SECTOR, Level, level_named
from arealis.session import get_spark

__all__ = ["DISTRICT", "SECTOR", "Level", "get_spark", "level_named"]
