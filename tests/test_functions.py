"""Column functions at every boundary."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carbonloom import constants as k
from carbonloom.functions import air, bands, calendar as cal, labels, ratios
from carbonloom.functions.text import code_key, name_key


@pytest.fixture
def apply(spark):
    """apply(function, values, type) -> results in order"""

    def run(function, values, dtype="double", *more):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]

    return run


def test_year_columns(apply):
    years = [1970, 1975, 1976, 1985, 1986, 2020, 2021, 2030, 2031, 2046, 2050]
    assert apply(cal.decade, years, "int") == [
        "1970s", "1970s", "1970s", "1980s", "1980s", "2020s", "2020s", "2030s", "2030s", "2040s", "2050s"
    ]
    phases = apply(cal.plan_phase, years, "int")
    assert phases[0] == phases[1] == "Giai đoạn trước 1976"
    assert phases[2] == "Kế hoạch 5 năm lần II (1976-1980)"
    assert phases[3] == "Kế hoạch 5 năm lần III (1981-1985)"
    assert phases[4] == "Kế hoạch 5 năm lần IV - Đổi mới (1986-1990)"
    assert phases[5] == "Kế hoạch 5 năm 2016-2020"
    assert phases[7] == "Kế hoạch 5 năm 2026-2030 (NDC Milestone)"
    assert phases[9] == phases[10] == k.PLAN_PHASE_AFTER
    assert len(set(apply(cal.plan_phase, range(1970, 2051), "int"))) == 16
    periods = apply(cal.policy_period, years, "int")
    assert [k.POLICY_PERIODS[0][1]] * 4 == periods[:4]
    assert periods[4:6] == [k.POLICY_PERIODS[1][1]] * 2
    assert periods[6:8] == [k.POLICY_PERIODS[2][1]] * 2
    assert periods[8:] == [k.POLICY_PERIOD_AFTER] * 3
    assert apply(cal.is_milestone, [2029, 2030, 2050, None], "int") == [False, True, True, False]
    assert apply(cal.is_pre_reform, [1985, 1986], "int") == [True, False]
    assert apply(cal.is_reform_era, [1985, 1986], "int") == [False, True]
    assert apply(cal.year_end_date, [2024], "int") == [datetime.date(2024, 12, 31)]


def test_hour_columns(apply):
    hours = list(range(24))
    assert apply(cal.hour_label, [0, 7, 23], "int") == ["00:00", "07:00", "23:00"]
    buckets = apply(cal.time_bucket, hours, "int")
    sizes = [buckets.count(b) for b in dict.fromkeys(buckets)]
    assert sizes == [6, 4, 6, 4, 4]
    rush = apply(cal.is_rush_hour, hours, "int")
    assert [h for h in hours if rush[h]] == [7, 8, 9, 17, 18, 19]


def test_index_scales(apply):
    values = [-0.1, 0.0, 0.8, 0.81, 1.2, 1.21, 70.0, 99.9, 100.0, None]
    strong, weak, coupled, negative = k.TAPIO_LABELS
    assert apply(bands.tapio_band, values) == [
        strong, weak, weak, coupled, coupled, negative, negative, negative, negative, negative
    ]
    green, middle, risk = k.GREEN_LABELS
    assert apply(bands.green_band, values) == [risk] * 6 + [middle, middle, green, risk]
    assert apply(bands.status_label, values) == [
        "Strong Decoupling", "Weak Decoupling", "Weak Decoupling", "Coupling", "Coupling",
        *["Negative Decoupling (Carbon Intensive)"] * 4, "No Data",
    ]
    assert apply(bands.status_color, values) == [
        "#10B981", "#F59E0B", "#F59E0B", *["#EF4444"] * 6, "#9CA3AF"
    ]


def test_quadrants(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)], "g double, c double")
    found = [r[0] for r in df.select(bands.quadrant(F.col("g"), F.col("c"), F.lit(2.0), F.lit(2.0))).collect()]
    assert found == list(k.QUADRANTS)


def test_air(spark, apply):
    assert apply(air.aqi_category, [50, 51, 100, 101, 150, 151, 200, 201, None], "int") == [
        "Tốt", "Trung bình", "Trung bình", "Kém", "Kém", "Xấu", "Xấu", "Rất xấu", "Rất xấu"
    ]
    assert apply(air.aqi_color, [50.0, 50.5, 100.0, 150.0, 200.0, 300.0, 300.5, None]) == [
        "#10B981", "#F59E0B", "#F59E0B", "#F97316", "#EF4444", "#8B5CF6", "#7F1D1D", "#9CA3AF"
    ]
    assert apply(air.is_exceeding, [50.0, 50.01]) == [False, True]
    df = spark.createDataFrame([(1.0, 1.0), (500.0, 1.0), (25.0, 0.0), (6.25, 1.875)], "p double, n double")
    # low clip, high clip, plain, and 14.5 which rounds half to even (14) and is clipped to 15
    assert [r[0] for r in df.select(air.aqi(F.col("p"), F.col("n"))).collect()] == [15, 320, 55, 15]
    half = spark.createDataFrame([(0.0, 41.25), (0.0, 43.75)], "p double, n double")
    assert [r[0] for r in half.select(air.aqi(F.col("p"), F.col("n"))).collect()] == [16, 18]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(Decimal("1.0000"), Decimal("3.00")), (Decimal("2"), Decimal("3")), (Decimal("5"), Decimal("0")),
         (Decimal("5"), None), (None, Decimal("2"))],
        "n decimal(18,4), d decimal(18,2)",
    )
    n, d = F.col("n"), F.col("d")
    guarded = [r[0] for r in df.select(ratios.guarded_ratio(n, d)).collect()]
    assert guarded == [Decimal("0.3333"), Decimal("0.6667"), 0, 0, None]
    assert [r[0] for r in df.select(ratios.divide(n, d)).collect()][2:] == [None, None, None]
    assert [r[0] for r in df.select(ratios.divide(n, d, 0.0)).collect()][2:] == [0.0, 0.0, None]
    assert [r[0] for r in df.select(ratios.blank_minus(n, d)).collect()] == [-2, -1, 5, 5, -2]
    growth = [r[0] for r in df.select(ratios.growth(n, d)).collect()]
    assert growth[3] is None and growth[4] == -1.0
    pairs = spark.createDataFrame([(32.0, 1.0), (1.0, 0.0), (None, 1.0), (1.0, None)], "c double, b double")
    cagr = [r[0] for r in pairs.select(ratios.cagr(F.col("c"), F.col("b"), 5)).collect()]
    assert cagr[0] == pytest.approx(1.0) and cagr[1:] == [None, None, None]


def test_total_row_guard(spark):
    df = spark.createDataFrame([("TOT", 5), ("ENG", 5)], "code string, gdp int")
    assert [r[0] for r in df.select(ratios.total_row_guard(F.col("gdp"), F.col("code"), "TOT")).collect()] == [5, None]


def test_labels(spark, apply):
    ampersand = ["Đồng bằng sông Hồng", "Trung du & Miền núi phía Bắc", "Bắc Trung Bộ & Duyên hải miền Trung",
                 "Tây Nguyên", "Đông Nam Bộ", "Đồng bằng sông Cửu Long", None]
    assert apply(labels.macro_region, ampersand, "string") == [
        "Miền Bắc", "Khác", "Khác", "Miền Trung", "Miền Nam", "Miền Nam", "Khác"
    ]
    assert apply(labels.macro_region_normalised, ampersand, "string") == [
        "Miền Bắc", "Miền Bắc", "Miền Trung", "Miền Trung", "Miền Nam", "Miền Nam", "Khác"
    ]
    assert apply(labels.scope_or_default, ["Scope 1", None], "string") == ["Scope 1", "Scope 1 & 2"]
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c")], "x string, y string, z string")
    path = [r[0] for r in df.select(labels.hierarchy_path(F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert path == ["a > b > c", None]


def test_name_keys(apply):
    names = ["Đà Nẵng", "Hà Nội\t", "Bà Rịa–Vũng Tàu", "Bà Rịa - Vũng Tàu", "TP. Hồ Chí Minh", "Thừa Thiên Huế",
             "plain", "Ñandú Ǻ", "a\x00b_c", "日本 Tokyo–2", "", None]
    assert apply(name_key, names, "string") == [
        "danang", "hanoi", "bariavungtau", "bariavungtau", "hochiminh", "thuathienhue", "plain", "nandua", "abc", "tokyo2", "", None
    ]
    assert apply(code_key, [" eng ", "ENG"], "string") == ["ENG", "ENG"]


def test_band_table_equals_the_chain(spark, rows):
    ends = [upper for upper, _ in k.PLAN_PHASES]
    table = [(a, b, c) for a, b, c in zip([None, *(e + 1 for e in ends)], [*ends, None], [*(t for _, t in k.PLAN_PHASES), k.PLAN_PHASE_AFTER])]
    years = spark.range(1900, 2100).select(F.col("id").cast("int").alias("y"))
    found = bands.by_band_table(years, F.col("y"), rows("lower int, upper int, label string", *table[::-1]), "phase")
    assert found.columns == ["y", "phase"]
    assert not found.withColumn("chain", cal.plan_phase(F.col("y"))).where("NOT phase <=> chain").count()
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_band_table_gaps_ends_and_faults(spark, rows):
    ddl, values = "lower double, upper double, label string", rows("v double", (0.5,), (1.0,), (2.0,), (2.5,), (3.0,), (9.0,), (None,))

    def labels(*table, after=None):
        found = bands.by_band_table(values, F.col("v"), rows(ddl, *table), "l", after)
        return [r.l for r in found.orderBy(F.col("v").asc_nulls_last()).collect()]

    assert labels((1.0, 2.0, "a"), (3.0, 3.0, "b")) == [None, "a", "a", None, "b", None, None]
    assert labels((1.0, 2.0, "a"), after=F.lit("-")) == ["-", "a", "a", "-", "-", "-", "-"]
    assert labels() == [None] * 7
    for bad in (((1.0, 2.0, "a"), (2.0, 3.0, "b")), ((2.0, 1.0, "a"),), ((None, None, "a"), (5.0, 6.0, "b"))):
        with pytest.raises(Exception, match="bands overlap"):
            labels(*bad)
    many = spark.range(4097).select((F.col("id") * 2).alias("lower"), (F.col("id") * 2).alias("upper"), F.lit("x").alias("label"))
    with pytest.raises(Exception, match="too many bands"):
        bands.by_band_table(values, F.col("v"), many, "l").collect()
    assert bands.by_band_table(values, F.col("v"), many.limit(4096), "l").where("l = 'x'").count() == 1
