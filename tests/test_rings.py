"""Rings stitched from shared arcs, from a topology file to features."""

import json

import pytest
from carbonloom.operators import geography, rings
from carbonloom.sources import topology
from helpers import as_dicts, by_key
from pyspark.sql import functions as F

# two neighbouring squares that share the arc (2, 0) – (2, 2); a ring of one arc; a place in two pieces
ARCS = [
    [[2, 0], [0, 1], [0, 1]],
    [[2, 2], [-2, 0], [0, -2], [2, 0]],
    [[2, 0], [2, 0], [0, 2], [-2, 0]],
    [[10, 10], [3, 0], [0, 3], [-3, -3]],
]
SHAPES = [("01", "Polygon", [[0, 1]]), ("02", "Polygon", [[2, -1]]), ("02", "MultiPolygon", [[[3]]]), ("03", None, None)]


def read(spark, tmp_path, arcs=ARCS, shapes=SHAPES):
    geometries = [{"type": t, "id": str(i), "arcs": a, "properties": {"code": c}} for i, (c, t, a) in enumerate(shapes)]
    text = {"type": "Topology", "transform": {"scale": [1, 1], "translate": [0, 0]}, "objects": {"raw": {"type": "GeometryCollection", "geometries": geometries}}, "arcs": arcs}
    (tmp_path / "map.json").write_text(json.dumps(text), encoding="utf-8")
    topo = topology.read_topology(spark, str(tmp_path / "map.json"))
    return topology.geometries(topo), topology.arcs(topo)


def walk(points):
    out = {}
    for r in as_dicts(points, *rings.RING, "place"):
        out.setdefault((r["position"], r["polygon"], r["ring"]), []).append((r["place"], r["x"], r["y"]))
    return out


def test_rings_are_walked_in_order(spark, tmp_path):
    shapes, arcs = read(spark, tmp_path)
    points = rings.ring_points(shapes, arcs)
    found = walk(points)
    assert all([p for p, _, _ in ring] == list(range(len(ring))) for ring in found.values())
    assert [(x, y) for _, x, y in found[0, 0, 0]] == [(2, 0), (2, 1), (2, 2), (0, 2), (0, 0), (2, 0)]
    assert [(x, y) for _, x, y in found[1, 0, 0]] == [(2, 0), (4, 0), (4, 2), (2, 2), (2, 1), (2, 0)]
    summary = {r["position"]: r for r in as_dicts(rings.ring_summary(points))}
    assert all(r["closed"] for r in summary.values()) and [summary[i]["points"] for i in (0, 1, 2)] == [6, 6, 4]
    assert [abs(summary[i]["area2"]) for i in (0, 1, 2)] == [8, 8, 9] and summary[2]["max_x"] == 13
    places = by_key(rings.place_summary(rings.ring_summary(points), shapes.select(*rings.FEATURE, F.col("properties")["code"].alias("code")), "code"), "code")
    assert [(places[c]["pieces"], places[c]["rings"], places[c]["closed_rings"], places[c]["type"]) for c in ("01", "02", "03")] == [
        (1, 1, 1, "Polygon"), (2, 2, 2, "MultiPolygon"), (1, 0, 0, "MultiPolygon")
    ]


def test_faulty_maps_fail(spark, tmp_path):
    for shape, match in ((("01", "Polygon", [[0, 3]]), "do not meet"), (("01", "Polygon", [[0, 99]]), "not there: 99")):
        shapes, arcs = read(spark, tmp_path, shapes=[shape])
        with pytest.raises(Exception, match=match):
            rings.ring_points(shapes, arcs).collect()
    shapes, arcs = read(spark, tmp_path, shapes=[("01", "Polygon", [[0, 2]])])  # meets backwards only
    with pytest.raises(Exception, match="do not meet"):
        rings.ring_points(shapes, arcs).collect()


def test_open_rings_are_told(spark, tmp_path):
    shapes, arcs = read(spark, tmp_path, shapes=[("01", "Polygon", [[0]]), ("02", "Polygon", [[-2]])])
    assert not any(r["closed"] for r in as_dicts(rings.ring_summary(rings.ring_points(shapes, arcs))))


def test_grouping_and_enriching(spark, rows, tmp_path):
    shapes, _ = read(spark, tmp_path)
    matched = shapes.where("ring_sets IS NOT NULL").select(F.col("properties")["code"].alias("code"), "ring_sets", "position")
    grouped = geography.group_features(matched, "code", "ring_sets", "position")
    found = by_key(grouped, "code")
    assert found["02"]["ring_sets"] == [[[2, -1]], [[3]]] and found["02"]["type"] == "MultiPolygon" and found["01"]["type"] == "Polygon"
    dim = rows("code string, name string", ("02", "B"), ("01", "A"), ("09", "C"))
    enriched = geography.enrich_features(grouped, dim, "code", ["name"]).collect()
    assert [(r.code, r.properties.name, r.properties.id) for r in enriched] == [("01", "A", "01"), ("02", "B", "02")]
