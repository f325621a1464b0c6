"""Map features as tables: name matching, grouping, decoding and checking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k
from ..functions.text import name_key


def match_names(
    raw: DataFrame, raw_name: str, master: DataFrame, master_name: str, aliases: dict[str, str] = k.NAME_ALIASES
) -> DataFrame:
    """Left join of raw names to the master list by name key; unmatched rows keep NULLs."""
    key = name_key(F.trim(F.col(raw_name)))
    if aliases:
        pairs = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
        key = F.coalesce(F.try_element_at(pairs, key), key)
    return raw.withColumn("match_key", key).join(
        master.withColumn("match_key", name_key(F.col(master_name))), "match_key", "left"
    )


def require_match(matched: DataFrame, raw_name: str, found: str) -> DataFrame:
    """Fails the job on a row without a match."""
    message = F.concat(F.lit("no master row for "), F.coalesce(F.col(raw_name), F.lit("NULL")))
    return matched.withColumn(found, F.when(F.col(found).isNull(), F.raise_error(message)).otherwise(F.col(found)))


def geometry_type(ring_sets: Column) -> Column:
    return F.when(F.size(ring_sets) == 1, "Polygon").otherwise(F.lit("MultiPolygon"))


def group_features(matched: DataFrame, key: str, ring_sets: str, order: str) -> DataFrame:
    """(key, ring_sets, type): the pieces of one place merged in their file order.

    A merged feature is one row by definition, so its pieces meet in one task.
    """
    pieces = matched.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, ring_sets))).alias("_pieces"))
    merged = F.flatten(F.transform("_pieces", lambda piece: piece[ring_sets]))
    return pieces.select(key, merged.alias("ring_sets")).withColumn("type", geometry_type(F.col("ring_sets")))


def feature_types(matched: DataFrame, key: str, ring_sets: str) -> DataFrame:
    """(key, pieces, rings, type) without bringing the geometry of a place together."""
    counted = matched.groupBy(key).agg(
        F.count(F.lit(1)).alias("pieces"), F.sum(F.size(ring_sets)).alias("rings")
    )
    return counted.withColumn("type", F.when(F.col("rings") == 1, "Polygon").otherwise(F.lit("MultiPolygon")))


def enrich_features(features: DataFrame, dim: DataFrame, code: str, properties: list[str]) -> DataFrame:
    """Features with their attributes in one ``properties`` struct, in code order."""
    attributes = dim.select(code, F.struct(F.col(code).alias("id"), code, *properties).alias("properties"))
    return features.join(attributes, code).orderBy(code)


def arc_extent(deltas: Column) -> Column:
    """min_x, min_y, max_x, max_y of a delta-coded arc, folded inside its row."""
    start = F.struct(
        F.lit(0).cast("long").alias("x"),
        F.lit(0).cast("long").alias("y"),
        *(F.lit(None).cast("long").alias(c) for c in ("min_x", "min_y", "max_x", "max_y")),
    )

    def step(acc, delta):
        x, y = acc["x"] + delta[0], acc["y"] + delta[1]
        return F.struct(
            x.alias("x"),
            y.alias("y"),
            F.least(acc["min_x"], x).alias("min_x"),
            F.least(acc["min_y"], y).alias("min_y"),
            F.greatest(acc["max_x"], x).alias("max_x"),
            F.greatest(acc["max_y"], y).alias("max_y"),
        )

    return F.aggregate(deltas, start, step)


def bounding_box(arcs: DataFrame, deltas: str, scale: tuple[Column, Column], shift: tuple[Column, Column]) -> DataFrame:
    """(min_lon, min_lat, max_lon, max_lat) over all arcs, rounded to 6 places.

    The transform is linear, so the extremes of the integer grid are enough.
    """
    e = arcs.withColumn("_e", arc_extent(F.col(deltas)))

    def ends(letter: str, axis: int) -> list[Column]:
        return [F.col(f"_e.{end}_{letter}") * scale[axis] + shift[axis] for end in ("min", "max")]

    return e.agg(
        F.round(F.min(F.least(*ends("x", 0))), 6).alias("min_lon"),
        F.round(F.min(F.least(*ends("y", 1))), 6).alias("min_lat"),
        F.round(F.max(F.greatest(*ends("x", 0))), 6).alias("max_lon"),
        F.round(F.max(F.greatest(*ends("y", 1))), 6).alias("max_lat"),
    )


def map_gate(
    features: DataFrame, box: DataFrame, master: DataFrame, code: str, name: str, expected: int = k.PROVINCE_COUNT
) -> DataFrame:
    """(check, value, passed) rows for a map of (code, name, ring_sets) features."""
    valid_code = F.col(code).isNotNull() & ~F.col(code).isin("", "00")
    basic = features.agg(
        F.count(F.lit(1)).alias("geometries"),
        F.count_if(~F.coalesce(valid_code, F.lit(False))).alias("invalid_codes"),
        F.count_if(F.coalesce(F.size("ring_sets"), F.lit(0)) <= 0).alias("empty_geometries"),
    )

    def finding(label: str, value: Column, passed: Column) -> Column:
        return F.struct(F.lit(label).alias("check"), value.alias("value"), passed.alias("passed"))

    counts = {c: F.col(c) for c in basic.columns}
    basic = basic.select(
        F.inline(
            F.array(
                finding("geometries", counts["geometries"], counts["geometries"] == expected),
                finding("invalid_codes", counts["invalid_codes"], counts["invalid_codes"] == 0),
                finding("empty_geometries", counts["empty_geometries"], counts["empty_geometries"] == 0),
            )
        )
    )

    def missing(label: str, left: DataFrame, right: DataFrame, column: str) -> DataFrame:
        gone = left.select(column).distinct().join(right.select(column), column, "left_anti")
        return gone.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(label).alias("check"), "value", (F.col("value") == 0).alias("passed")
        )

    valid = features.where(valid_code)
    edges = ("min_lon", "min_lat", "max_lon", "max_lat")
    inside = F.lit(True)
    for edge, (low, high) in zip(edges, k.MAP_LIMITS):
        inside = inside & F.col(edge).between(low, high)
    extent = box.select(
        F.lit("bounding_box").alias("check"),
        F.coalesce(inside, F.lit(False)).cast("long").alias("value"),
        F.coalesce(inside, F.lit(False)).alias("passed"),
    )
    return (
        basic.unionByName(missing("missing_codes", master, valid, code))
        .unionByName(missing("extra_codes", valid, master, code))
        .unionByName(missing("missing_names", master, features, name))
        .unionByName(extent)
    )
