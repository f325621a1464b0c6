"""Rings of map features, stitched from shared arcs over rows.

A ring lists arcs by number; a negative number n stands for arc -n - 1 walked backwards. Every point of a ring gets its place
from the sizes of the arcs before it, so points are never gathered or sorted as a whole: arcs are decoded by running sums, and
a ring's points are the join of its references with the arcs' points. An arc begins where the one before ended; that point
counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .series import running_sums

FEATURE = ("file", "layer", "position")
RING = (*FEATURE, "polygon", "ring")


def ring_references(geometries: DataFrame) -> DataFrame:
    """(file, layer, position, polygon, ring, turn, arc_id, reversed): the arcs of every ring, in order."""
    sets = geometries.where(F.col("ring_sets").isNotNull()).select(*FEATURE, F.posexplode("ring_sets").alias("polygon", "rings"))
    rings = sets.select(*FEATURE, "polygon", F.posexplode("rings").alias("ring", "arcs"))
    rows = rings.select(*RING, F.posexplode("arcs").alias("turn", "arc"))
    backwards = F.col("arc") < 0
    return rows.select(*RING, "turn", F.when(backwards, -F.col("arc") - 1).otherwise(F.col("arc")).alias("arc_id"), backwards.alias("reversed"))


def arc_points(arcs: DataFrame) -> DataFrame:
    """(file, arc_id, pos, last, x, y): every point of the grid, the last one's number beside it."""
    steps = arcs.select("file", F.col("arc_id"), (F.size("deltas") - 1).alias("last"), F.posexplode("deltas").alias("pos", "d"))
    steps = steps.select("file", "arc_id", "last", "pos", F.col("d")[0].alias("dx"), F.col("d")[1].alias("dy"))
    summed = running_sums(steps, ["file", "arc_id"], "pos", ["dx", "dy"])
    return summed.select("file", "arc_id", "pos", "last", F.col("running_dx").alias("x"), F.col("running_dy").alias("y"))


def ring_points(geometries: DataFrame, arcs: DataFrame) -> DataFrame:
    """(file, layer, position, polygon, ring, place, x, y) of all rings; ``place`` counts from 0 without a gap.

    An arc that is missing, or does not begin where the one before it ended, fails the job.
    """
    sizes = arcs.select("file", "arc_id", (F.size("deltas") - 1).alias("last"))
    references = ring_references(geometries).join(sizes, ["file", "arc_id"], "left")
    unknown = F.raise_error(F.concat(F.lit("a ring names an arc that is not there: "), F.col("arc_id").cast("string"))).cast("int")
    references = references.withColumn("last", F.when(F.col("last").isNull(), unknown).otherwise(F.col("last")))
    # one row per arc of a ring: the window is as long as a ring has arcs, not points
    before = Window.partitionBy(*RING).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = references.withColumn("start", F.coalesce(F.sum("last").over(before), F.lit(0)))
    points = placed.drop("last").join(arc_points(arcs), ["file", "arc_id"])
    local = F.when(F.col("reversed"), F.col("last") - F.col("pos")).otherwise(F.col("pos"))
    points = points.withColumn("_local", local)
    # where two arcs meet, both bring the point: it must be the same one
    met = points.groupBy(*RING, (F.col("start") + F.col("_local")).alias("place")).agg(
        F.min("x").alias("x"), F.min("y").alias("y"), F.max("x").alias("_x"), F.max("y").alias("_y")
    )
    broken = F.raise_error(F.concat(F.lit("arcs do not meet at place "), F.col("place").cast("string"))).cast("boolean")
    same = (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))
    return met.where(F.when(same, F.lit(True)).otherwise(broken)).drop("_x", "_y")


def ring_summary(points: DataFrame) -> DataFrame:
    """Per ring its number of points, whether it is closed, its extent, and twice its signed area.

    Each point's next one comes by a join on its place, so that a ring of very many points is not sorted in one task.
    """
    ahead = points.select(*RING, (F.col("place") - 1).alias("place"), F.col("x").alias("_nx"), F.col("y").alias("_ny"))
    found = points.join(ahead, [*RING, "place"], "left").groupBy(*RING).agg(
        F.count(F.lit(1)).alias("points"),
        F.min_by(F.struct("x", "y"), "place").alias("_first"),
        F.max_by(F.struct("x", "y"), "place").alias("_last"),
        *(f(c).alias(f"{name}_{c}") for c in ("x", "y") for name, f in (("min", F.min), ("max", F.max))),
        F.coalesce(F.sum(F.col("x") * F.col("_ny") - F.col("_nx") * F.col("y")), F.lit(0)).alias("area2"),
    )
    return found.withColumn("closed", (F.col("_first") == F.col("_last")) & (F.col("points") > 3)).drop("_first", "_last")


def place_summary(rings: DataFrame, matched: DataFrame, code: str) -> DataFrame:
    """(code, pieces, polygons, rings, closed_rings, points, type) per place, without bringing its geometry together.

    ``matched`` has file, layer, position and the place's code: several features may be pieces of one place.
    """
    per_polygon = rings.groupBy(*FEATURE, "polygon").agg(
        F.count(F.lit(1)).alias("rings"), F.count_if("closed").alias("closed_rings"), F.sum("points").alias("points")
    )
    per_feature = per_polygon.groupBy(*FEATURE).agg(F.count(F.lit(1)).alias("polygons"), *(F.sum(c).alias(c) for c in ("rings", "closed_rings", "points")))
    joined = matched.select(*FEATURE, code).join(per_feature, list(FEATURE), "left")
    found = joined.groupBy(code).agg(
        F.count(F.lit(1)).alias("pieces"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("polygons", "rings", "closed_rings", "points"))
    )
    return found.withColumn("type", F.when(F.col("polygons") == 1, "Polygon").otherwise(F.lit("MultiPolygon")))
