"""Topology files: geometries and arcs as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as k

TOPOLOGY = (
    "struct<type: string, bbox: array<double>, "
    "transform: struct<scale: array<double>, translate: array<double>>, "
    "objects: map<string, struct<type: string, geometries: array<struct<"
    "type: string, id: string, arcs: string, properties: map<string, string>>>>>, "
    "arcs: array<array<array<bigint>>>>"
)


def read_topology(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (file, size_kb, topology)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"),
        (F.col("_metadata.file_size") / 1024.0).alias("size_kb"),
        F.from_json("value", TOPOLOGY).alias("topology"),
    )


def geometries(topologies: DataFrame) -> DataFrame:
    """(file, layer, position, type, id, properties, ring_sets); a polygon is one set of rings."""
    layers = topologies.select("file", F.explode("topology.objects").alias("layer", "object"))
    rows = layers.select("file", "layer", F.posexplode("object.geometries").alias("position", "g"))
    several = F.from_json("g.arcs", "array<array<array<bigint>>>")
    single = F.array(F.from_json("g.arcs", "array<array<bigint>>"))
    unknown = F.raise_error(F.concat(F.lit("unsupported geometry type: "), F.col("g.type")))
    return rows.select(
        "file",
        "layer",
        "position",
        F.col("g.type").alias("type"),
        F.col("g.id").alias("id"),
        F.col("g.properties").alias("properties"),
        F.when(F.col("g.arcs").isNull(), F.lit(None))
        .when(F.col("g.type") == "Polygon", single)
        .when(F.col("g.type") == "MultiPolygon", several)
        .otherwise(unknown.cast("array<array<array<bigint>>>"))
        .alias("ring_sets"),
    )


def arcs(topologies: DataFrame) -> DataFrame:
    """(file, arc_id, deltas, scale, translate); the deltas stay one array per arc."""
    return topologies.select(
        "file",
        F.col("topology.transform.scale").alias("scale"),
        F.col("topology.transform.translate").alias("translate"),
        F.posexplode("topology.arcs").alias("arc_id", "deltas"),
    )


def chosen_layer(rows: DataFrame, layers: tuple[str, ...] = k.MAP_LAYERS) -> DataFrame:
    """Rows of the first of ``layers`` that a file has."""
    rank = F.array_position(F.array(*(F.lit(name) for name in layers)), F.col("layer"))
    ranked = rows.withColumn("_rank", F.nullif(rank, F.lit(0))).where(F.col("_rank").isNotNull())
    best = ranked.groupBy("file").agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, ["file", "_rank"], "left_semi").drop("_rank")


def file_checks(topologies: DataFrame, size_kb: tuple[int, int] = k.MAP_KB) -> DataFrame:
    """(file, is_topology, has_objects, has_bbox, size_ok) per file."""
    t = F.col("topology")
    return topologies.select(
        "file",
        F.coalesce(t["type"] == "Topology", F.lit(False)).alias("is_topology"),
        (F.coalesce(F.size(t["objects"]), F.lit(0)) > 0).alias("has_objects"),
        F.coalesce(F.size(t["bbox"]) == 4, F.lit(False)).alias("has_bbox"),
        F.col("size_kb").between(*size_kb).alias("size_ok"),
    )
