"""Files in and out: BOM, blanks, short and long lines, payloads, topology, publishing."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carbonloom.operators import geography
from carbonloom.operators.constraints import non_negative
from carbonloom.sources import csvfiles, payloads, schemas, tables, topology
from helpers import as_dicts, by_key

BOM = "﻿"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_read_csv(spark, tmp_path):
    path = write(
        tmp_path / "p.csv",
        BOM + "Province_Code,Province_Name,Province_Name_Ascii,Region,Economic_Zone,Area_Km2,Is_Industrial_Hub\n"
        "01,Hà Nội,Ha Noi,R,Z,3359.8,1\n02,Hà Giang,Ha Giang,R,Z,,0\n",
    )
    found = by_key(csvfiles.read_csv(spark, path, schemas.PROVINCES, schemas.PROVINCE_BLANKS), "Province_Code")
    assert found["01"]["Province_Name"] == "Hà Nội" and found["01"]["Is_Industrial_Hub"] is True
    assert found["01"]["Area_Km2"] == Decimal("3359.80")
    assert found["02"]["Area_Km2"] == 0 and found["02"]["Is_Industrial_Hub"] is False


def test_blank_is_null_or_zero_per_table(spark, tmp_path):
    national = write(
        tmp_path / "n.csv",
        "Year,CO2_MtCO2e,CO2_Per_Capita_Tonnes,GDP_USD,Methane_MtCO2e,Renewable_Energy_Pct,Total_GHG_MtCO2e\n"
        "1970,17.5073,0.422114597073964,,40.5772, ,62.6817\n",
    )
    row = csvfiles.read_csv(spark, national, schemas.NATIONAL).first()
    assert row.GDP_USD is None and row.Renewable_Energy_Pct is None
    assert row.CO2_Per_Capita_Tonnes == Decimal("0.422115")
    provincial = write(
        tmp_path / "e.csv",
        "Year,Province_Code,Province_Name,GRDP_Billion_VND,Population,Industrial_Output_Billion_VND,"
        "Forest_Coverage_Pct,Estimated_Carbon_Tonnes,Decoupling_Index\n2015,01,Hà Nội,,8400000,,5.5,1,\n",
    )
    row = csvfiles.read_csv(spark, provincial, schemas.PROVINCIAL, schemas.PROVINCIAL_BLANKS).first()
    assert row.GRDP_Billion_VND == 0 and row.Decoupling_Index == 0 and row.Province_Code == "01"


LINE = "2024,2024,1,1,0,ST-01-01,01,500.10,1.00,20.00,10.00,30.00,50.00,74,Trung bình,0"


def test_bulk_load_drops_short_lines_and_keeps_long_ones(spark, tmp_path):
    header = ",".join(s.split()[0] for s in schemas.HOURLY.split(", "))
    path = write(tmp_path / "h.csv", BOM + header + "\n" + LINE + "\n1,2,3\n" + LINE.replace("ST-01-01", "ST-01-02") + ",x\n")
    rows = as_dicts(csvfiles.bulk_load(spark, path, schemas.HOURLY), "Station_Code")
    assert [r["Station_Code"] for r in rows] == ["ST-01-01", "ST-01-02"]
    assert rows[0]["CO2_ppm"] == Decimal("500.10") and rows[0]["Is_Exceeding_QCVN"] is False
    counts = csvfiles.bulk_lines(spark, path, schemas.HOURLY).agg(*csvfiles.line_counts()).first()
    assert (counts.kept, counts.dropped) == (2, 1)
    bad = write(tmp_path / "bad.csv", LINE.replace("500.10", "abc") + "\n")
    with pytest.raises(Exception):
        csvfiles.bulk_load(spark, bad, schemas.HOURLY).collect()


def test_write_csv_round_trip(spark, rows, tmp_path):
    df = rows("Province_Code string, Province_Name string", ("01", "Hà Nội"), ("48", "Đà Nẵng"))
    csvfiles.write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert as_dicts(back, "Province_Code") == as_dicts(df, "Province_Code")


def test_indicator_payload(spark, tmp_path):
    payload = {
        "NY.GDP.MKTP.CD": [{"date": "2020", "value": 1.5, "country": {"id": "VN"}}, {"date": "2021", "value": None},
                           {"date": "2021Q1", "value": 9}],
        "unknown": [{"date": "2020", "value": 3}],
    }
    write(tmp_path / "wb.json", json.dumps(payload, indent=1))
    read = payloads.read_payloads(spark, str(tmp_path / "wb.json"))
    assert read.first().source_file == "wb.json"
    found = payloads.indicator_rows(read, indicators={"NY.GDP.MKTP.CD": "GDP_USD"})
    assert as_dicts(found, "Year") == [
        {"Year": 2020, "Indicator": "GDP_USD", "Value": 1.5, "position": 0},
        {"Year": 2021, "Indicator": "GDP_USD", "Value": None, "position": 1},
    ]
    payloads.land_payload(read, str(tmp_path / "raw"))
    kept = spark.read.text(str(tmp_path / "raw/*.txt"), wholetext=True).first()[0]
    assert json.loads(kept) == payload


def test_response_shape(rows):
    df = rows("payload string", ('[{"page":1},[{"date":"2020","value":2.5}]]',), ('[{"message":"x"}]',))
    found = payloads.response_records(df).select("records").collect()
    assert found[0].records[0].value == 2.5 and found[1].records is None


def test_sector_payload(rows):
    def item(sector, gas, *points):
        return {"sector": sector, "gas": gas, "source": "S", "emissions": [{"year": y, "value": v} for y, v in points]}

    payload = {"data": [
        item("Energy", "All GHG", (1990, 1.0), (1991, None), (None, 5.0), (0, 5.0)),
        item("Energy", "N2O", (1990, 7.0)),
        item("Bunker Fuels", "CO2", (1990, 2.0)),
        item("Other Fuels", "CO2", (1990, 3.0)),
        item("Energy", "All GHG", (1990, 9.0)),
    ]}
    from carbonloom.operators.series import keep_first

    df = rows("payload string", (json.dumps(payload),))
    mapped = payloads.map_sectors(payloads.sector_rows(df))
    assert mapped.count() == 4
    kept = keep_first(mapped, ["Year", "Sector_Code", "Gas"], ["item_pos", "point_pos"])
    found = {r.Sector_Code: r for r in kept.collect()}
    assert set(found) == {"ENG", "OTH"}
    assert found["ENG"].Emissions_MtCO2e == 1.0 and found["ENG"].Sector_Name_VI == "Năng lượng & Khai khoáng"
    assert found["OTH"].Sector_Name_EN == "Bunker Fuels" and found["OTH"].Sector_Category == "Other"


TOPOLOGY = {
    "type": "Topology",
    "bbox": [0, 0, 1, 1],
    "transform": {"scale": [0.5, 0.25], "translate": [100, 8]},
    "arcs": [[[0, 0], [2, 0], [0, 4], [-2, -4]], [[10, 10], [-3, 2]], [[4, 4], [1, 1]]],
    "objects": {
        "raw": {"type": "GeometryCollection", "geometries": [
            {"type": "Polygon", "arcs": [[0]], "properties": {"shapeName": "Bà Rịa–Vũng Tàu"}},
            {"type": "MultiPolygon", "arcs": [[[1]], [[-1, 2]]], "properties": {"shapeName": "Côn Đảo"}},
            {"type": "Polygon", "arcs": [[2]], "properties": {"shapeName": "Hà Nội\t"}},
        ]},
    },
}


@pytest.fixture
def topo(spark, tmp_path):
    write(tmp_path / "m.topojson", json.dumps(TOPOLOGY, indent=1))
    return topology.read_topology(spark, str(tmp_path / "m.topojson"))


@pytest.fixture
def master(rows):
    return rows(
        "Province_Code string, Province_Name string, Region string",
        ("77", "Bà Rịa - Vũng Tàu", "SE"), ("01", "Hà Nội", "RRD"),
    )


def test_topology_matching_grouping_and_types(topo, master):
    shapes = topology.geometries(topo).withColumn("name", F.col("properties")["shapeName"])
    matched = geography.require_match(
        geography.match_names(shapes, "name", master, "Province_Name"), "name", "Province_Code"
    )
    grouped = geography.group_features(matched, "Province_Code", "ring_sets", "position")
    found = by_key(grouped, "Province_Code")
    assert found["77"]["ring_sets"] == [[[0]], [[1]], [[-1, 2]]] and found["77"]["type"] == "MultiPolygon"
    assert found["01"]["ring_sets"] == [[[2]]] and found["01"]["type"] == "Polygon"
    enriched = geography.enrich_features(grouped, master, "Province_Code", ["Province_Name", "Region"]).collect()
    assert [r.Province_Code for r in enriched] == ["01", "77"]
    assert enriched[0].properties.id == "01" and enriched[0].properties.Region == "RRD"


def test_unmatched_name_fails(topo, master):
    shapes = topology.geometries(topo).withColumn("name", F.col("properties")["shapeName"])
    only = master.where("Province_Code = '77'")
    with pytest.raises(Exception, match="no master row"):
        geography.require_match(
            geography.match_names(shapes, "name", only, "Province_Name"), "name", "Province_Code"
        ).collect()


def test_bounding_box(topo):
    arcs = topology.arcs(topo)
    scale = (F.col("scale")[0], F.col("scale")[1])
    shift = (F.col("translate")[0], F.col("translate")[1])
    box = geography.bounding_box(arcs, "deltas", scale, shift).first()
    assert tuple(box) == (100.0, 8.0, 105.0, 11.0)


def test_map_gate(topo, master, rows):
    features = rows(
        "Province_Code string, Province_Name string, ring_sets array<array<array<bigint>>>",
        ("77", "Bà Rịa - Vũng Tàu", [[[0]]]), ("00", "Nowhere", [[[0]]]), ("99", "Extra", []),
    )
    box = rows("min_lon double, min_lat double, max_lon double, max_lat double", (102.1, 8.4, 115.0, 23.4))
    found = by_key(geography.map_gate(features, box, master, "Province_Code", "Province_Name", 3), "check")
    assert {c: r["value"] for c, r in found.items()} == {
        "geometries": 3, "invalid_codes": 1, "empty_geometries": 1, "missing_codes": 1, "extra_codes": 1,
        "missing_names": 1, "bounding_box": 1,
    }
    assert {c for c, r in found.items() if r["passed"]} == {"geometries", "bounding_box"}
    checks = topology.file_checks(topo).first()
    assert checks.is_topology and checks.has_objects and checks.has_bbox and not checks.size_ok
    assert topology.chosen_layer(topology.geometries(topo), ("provinces", "raw")).count() == 3


def test_dimension_versions(spark, rows, tmp_path):
    path = str(tmp_path / "dim")
    ddl = "k bigint, code string"
    assert tables.published(spark, path) is None
    tables.publish_dimension(spark, rows(ddl, (7, "a")), path, "k", "code")
    first = tables.published(spark, path)
    grown = spark.read.parquet(first).union(rows(ddl, (9, "b")))
    tables.publish_dimension(spark, grown, path, "k", "code")
    second = tables.published(spark, path)
    assert second != first and sorted(r.k for r in spark.read.parquet(second).collect()) == [7, 9]
    # a failed check leaves the pointer, and so the keys, as they were
    for bad in (rows(ddl, (1, None)), rows(ddl, (1, "a"), (1, "b")), rows(ddl, (1, "a"), (2, "a"))):
        with pytest.raises(ValueError):
            tables.publish_dimension(spark, bad, path, "k", "code")
        assert tables.published(spark, path) == second
    tables.publish_dimension(spark, spark.read.parquet(second), path, "k", "code")
    assert len([p for p in (tmp_path / "dim" / "versions").iterdir()]) == 2
    (tmp_path / "dim" / "current").unlink()
    with pytest.raises(FileNotFoundError, match="without a pointer"):
        tables.published(spark, path)


def test_csv_quotes_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    ddl = "Province_Code string, Province_Name string, Area_Km2 double"
    cells = [("01", 'Tỉnh "A", B', 1.5), ("02", "plain", None), ("03", 'two\nlines, "quoted"', 2.0)]
    csvfiles.write_csv(rows(ddl, *cells), path)
    found = csvfiles.read_csv(spark, path, ddl, line_ends_in_cells=True).collect()
    assert sorted((r.Province_Code, r.Province_Name, r.Area_Km2) for r in found) == cells
    (tmp_path / "one.csv").write_text('\ufeffProvince_Code,Province_Name,Area_Km2\n01,"Tỉnh ""A"", B",3\n', encoding="utf-8")
    one = csvfiles.read_csv(spark, str(tmp_path / "one.csv"), ddl).first()
    assert (one.Province_Name, one.Area_Km2) == ('Tỉnh "A", B', 3.0)


def test_staging_lineage_and_truncate(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    tables.stage_overwrite(rows("a int", (1,)), path, "a.csv")
    tables.stage_overwrite(rows("a int", (2,), (3,)), path, "b.csv")
    read = spark.read.parquet(path)
    assert read.count() == 2 and read.first().Source_File == "b.csv" and read.first().Loaded_At is not None
    tables.truncate(spark, path)
    assert spark.read.parquet(path).count() == 0


def test_cells_that_do_not_fit_are_told_from_blank_ones(rows):
    cells = ("", " ", "7", "007", "9" * 38, "1" + "0" * 38, "0" * 50 + "5", "x", None)
    df = rows("i int, c string", *enumerate(cells)).select("i", csvfiles.unfit(F.col("c"), "decimal(38,0)").alias("unfit"))
    assert [r.unfit for r in df.orderBy("i").collect()] == [False, False, False, False, False, True, False, True, None]


def test_landed_records_keep_late_fields_and_read_known_ones_as_columns(spark, rows, tmp_path):
    path = str(tmp_path / "landed")
    first = [('{"year": 2020, "value": 1.5, "place": {"code": "01"}}',)] * 20 + [("not JSON",), (None,), ("[1, 2]",)]
    later = [('{"year": "2021", "value": "2.25", "place": {"code": 7}, "late": [1, {"a": 2}]}',), ('{"value": {"odd": 1}}',)]
    for batch in (first, later):
        payloads.land_records(rows("record string", *batch), path)
    before = {name: spark.conf.get(name) for name in payloads.SHREDDING}
    try:
        for name, value in payloads.SHREDDING.items():
            spark.conf.set(name, value)
        fields = {"Year": ("$.year", "int"), "Value": ("$.value", "decimal(9,2)"), "Code": ("$.place.code", "string"), "Late": ("$.late[1].a", "int")}
        found = payloads.landed_fields(spark, path, fields, ("unparsed",))
        known = [(r.Year, r.Value and float(r.Value), r.Code, r.Late) for r in found.collect()]
        assert sorted(known, key=str) == sorted([(2020, 1.5, "01", None)] * 20 + [(None,) * 4] * 4 + [(2021, 2.25, "7", 2)], key=str)
        assert [r.unparsed for r in found.where("unparsed IS NOT NULL").collect()] == ["not JSON"]
        plan = found.select("Year")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<record:struct<0:int>>" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # whatever came can be had again
    whole = spark.read.parquet(path).select(F.to_json("record").alias("j")).where("j LIKE '%late%'").first().j
    assert json.loads(whole) == {"year": "2021", "value": "2.25", "place": {"code": 7}, "late": [1, {"a": 2}]}
