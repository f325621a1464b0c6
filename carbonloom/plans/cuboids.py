"""Air measures at many grains from one scan, and from stored sums.

A grain is a set of dimension columns. All grains come out of one aggregate with grouping sets over the star: sums that
add up further (sums, counts, hits), never means. A measure that ignores a filter column (rush hours) reads the sums of the
grain without that column, summed from the finer one. Stored, the sums answer every grain that is part of a stored one, from
the stored one of fewest rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import air
from ..operators.lookup import star
from ..sources import snapshots
from ..sources.tables import _read_text, _write_text
from .measures import AVERAGED

Grain = tuple[str, ...]
#: Sums of a grain's rows; all add up.
SUMS = tuple(f"{c}_{kind}" for c in AVERAGED.values() for kind in ("sum", "n")) + ("exceeding", "rush_exceeding", "readings")
RUSH = "Is_Rush_Hour"
MEASURES = (*AVERAGED, "Exceeding_QCVN_Hours", "Exceeding_QCVN_Rate", "Rush_Hour_Exceeding_Hours", "AQI_Status_Color_Hex")


def star_rows(fact: DataFrame, dates: DataFrame, hours: DataFrame, provinces: DataFrame, stations: DataFrame) -> DataFrame:
    """The fact joined to its dimensions, with one row's share of every sum."""
    rows = star(fact, (dates.select("Date_Key", "Year"), "Date_Key"), (hours, "Time_Key"), (provinces, "Province_Key"))
    rows = rows.join(stations.drop("Province_Key"), "Station_Key")
    exceeding = F.col("Is_Exceeding_QCVN").cast("int")
    return rows.select(
        *(c for c in rows.columns if c not in fact.columns or c in ("Date_Key", "Month")),
        *(F.col(c).alias(f"{c}_sum") for c in AVERAGED.values()),
        *(F.col(c).isNotNull().cast("int").alias(f"{c}_n") for c in AVERAGED.values()),
        exceeding.alias("exceeding"),
        F.when(F.col(RUSH), exceeding).alias("rush_exceeding"),
        F.lit(1).alias("readings"),
    )


def _names(grains: Iterable[Grain]) -> list[str]:
    return list(dict.fromkeys(c for grain in grains for c in grain))


def label(grain: Sequence[str]) -> str:
    return "+".join(sorted(grain))


def sums_at(rows: DataFrame, grains: Sequence[Grain]) -> DataFrame:
    """(grain, every dimension column, sums): one aggregate for all grains; a column that is not of a grain is NULL there."""
    names = _names(grains)
    # bit i of the grouping id, from the left, says that column i is summed away
    number = {sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in grain): label(grain) for grain in grains}
    found = rows.groupingSets([[F.col(c) for c in grain] for grain in grains], *(F.col(c) for c in names))
    out = found.agg(F.grouping_id().alias("_id"), *(F.sum(c).alias(c) for c in SUMS))
    which = F.coalesce(*(F.when(F.col("_id") == i, F.lit(text)) for i, text in number.items()))
    return out.select(which.alias("grain"), *names, *SUMS)


def _measures(total, rush: Column) -> list[Column]:
    def mean(column: str) -> Column:
        return F.try_divide(total(f"{column}_sum").cast("double"), total(f"{column}_n"))

    rate = F.try_divide(total("exceeding").cast("double"), total("readings"))
    return [
        *(mean(column).alias(name) for name, column in AVERAGED.items()),
        total("exceeding").alias("Exceeding_QCVN_Hours"),
        F.coalesce(rate, F.lit(0.0)).alias("Exceeding_QCVN_Rate"),
        rush.alias("Rush_Hour_Exceeding_Hours"),
        air.aqi_color(mean("AQI_Index")).alias("AQI_Status_Color_Hex"),
    ]


def measures_of(sums: DataFrame) -> DataFrame:
    """The measures of rows of :func:`sums_at`, in place of the sums. The window runs over the grains' few rows."""
    names = [c for c in sums.columns if c not in ("grain", *SUMS)]
    if RUSH not in names:
        return sums.select("grain", *names, *_measures(F.col, F.col("rush_exceeding")))
    whole = Window.partitionBy("grain", *(c for c in names if c != RUSH))
    return sums.select("grain", *names, *_measures(F.col, F.sum("rush_exceeding").over(whole)))


def store(rows: DataFrame, path: str, grains: Sequence[Grain], of: dict[str, object]) -> None:
    """Writes the sums of all grains, a slice per grain, and what they are ``of`` (the fact's version, say)."""
    spark, old = rows.sparkSession, snapshots.snapshot(rows.sparkSession, path)
    replaced = {f"grain={label(g)}" for g in grains} | set(old.slices if old else ())
    new = snapshots.replace(sums_at(rows, grains), path, ["grain"], sorted(replaced), note=of)
    counts = {r.grain: r.n for r in snapshots.read(spark, path).groupBy("grain").agg(F.count(F.lit(1)).alias("n")).collect()}
    _write_text(spark, f"{path}/rows", json.dumps({label(g): counts.get(label(g), 0) for g in grains} | {"": new.version}))


def coarsest(stored: dict[str, int], needed: Iterable[str]) -> str | None:
    """The stored grain of fewest rows that has all ``needed`` columns."""
    fitting = [(n, text) for text, n in stored.items() if set(needed) <= set(text.split("+"))]
    return min(fitting)[1] if fitting else None


def stored_grains(spark: SparkSession, path: str, of: dict[str, object]) -> dict[str, int]:
    """Rows of each stored grain; none where the sums are not ``of`` what is asked for."""
    state, text = snapshots.snapshot(spark, path), _read_text(spark, f"{path}/rows")
    if state is None or text is None or state.note != of:
        return {}
    found = json.loads(text)
    return found if found.pop("") == state.version else {}


def answer(spark: SparkSession, path: str, of: dict[str, object], by: Sequence[str], where: Column | None = None, reads: Sequence[str] = ()) -> DataFrame | None:
    """The measures by ``by`` from stored sums; None where no stored grain has ``by`` and what the filter ``reads``."""
    chosen = coarsest(stored_grains(spark, path, of), {*by, *reads})
    if chosen is None:
        return None
    state = snapshots.snapshot(spark, path)
    sums = snapshots.read_slices(spark, path, state, [f"grain={chosen}"])
    sums = sums if where is None else sums.where(where)
    found = sums.groupBy(*by).agg(*(F.sum(c).alias(c) for c in SUMS))
    return measures_of(found.withColumn("grain", F.lit(label(by)))).select(*by, *MEASURES)
