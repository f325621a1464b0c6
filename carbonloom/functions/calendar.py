"""Columns derived from a year or an hour."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as k
from .bands import by_upper_bound


def decade(year: Column) -> Column:
    return F.concat((year - year % 10).cast("int").cast("string"), F.lit("s"))


def plan_phase(year: Column, phases=k.PLAN_PHASES, after=k.PLAN_PHASE_AFTER) -> Column:
    return by_upper_bound(year, phases, after)


def policy_period(year: Column, periods=k.POLICY_PERIODS, after=k.POLICY_PERIOD_AFTER) -> Column:
    return by_upper_bound(year, periods, after)


def is_milestone(year: Column, years=k.MILESTONE_YEARS) -> Column:
    return F.coalesce(year.isin(*years), F.lit(False))


def is_pre_reform(year: Column, reform_year: int = k.REFORM_YEAR) -> Column:
    return F.coalesce(year < reform_year, F.lit(False))


def is_reform_era(year: Column, reform_year: int = k.REFORM_YEAR) -> Column:
    return F.coalesce(year >= reform_year, F.lit(False))


def year_end_date(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def time_bucket(hour: Column, buckets=k.TIME_BUCKETS, after=k.TIME_BUCKET_AFTER) -> Column:
    return by_upper_bound(hour, buckets, after)


def is_rush_hour(hour: Column, hours=k.RUSH_HOURS) -> Column:
    return F.coalesce(hour.isin(*hours), F.lit(False))
