"""Air-quality index, class and limit flag of one reading."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as k
from .bands import by_upper_bound


def aqi(pm25: Column, no2: Column) -> Column:
    """Weighted sum, rounded half to even, clipped."""
    raw = F.rint(pm25.cast("double") * k.AQI_PM25 + no2.cast("double") * k.AQI_NO2)
    return F.least(F.greatest(raw, F.lit(float(k.AQI_LOW))), F.lit(float(k.AQI_HIGH))).cast("int")


def aqi_category(index: Column, bands=k.AQI_CATEGORIES, after=k.AQI_CATEGORY_AFTER) -> Column:
    return by_upper_bound(index, bands, after)


def aqi_color(index: Column, bands=k.AQI_COLORS, after=k.AQI_COLOR_AFTER, none=k.AQI_COLOR_NONE) -> Column:
    return F.when(index.isNull(), none).otherwise(by_upper_bound(index, bands, after))


def is_exceeding(pm25: Column, limit=k.PM25_LIMIT) -> Column:
    return pm25 > limit
