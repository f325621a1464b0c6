"""Nested API payloads as rows. A payload file is one JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as k

INDICATOR_PAYLOAD = "map<string, array<struct<date: string, value: double>>>"
RESPONSE_RECORDS = "array<struct<date: string, value: double>>"
SECTOR_PAYLOAD = (
    "struct<data: array<struct<sector: string, gas: string, source: string, "
    "emissions: array<struct<year: int, value: double>>>>>"
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(payload, source_file), one row per JSON file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("source_file")
    )


def land_payload(df: DataFrame, path: str) -> None:
    """Keeps the payloads as they came, for audit."""
    df.select("payload").write.mode("append").text(path)


def response_records(df: DataFrame, response: str = "payload", type_: str = RESPONSE_RECORDS) -> DataFrame:
    """Records of a ``[meta, records]`` response; any other shape has none."""
    parts = F.from_json(F.col(response), "array<string>")
    return df.withColumn("records", F.from_json(F.get(parts, 1), type_))


def indicator_rows(
    df: DataFrame,
    payload: str = "payload",
    indicators: dict[str, str] | None = None,
    keep: tuple[str, ...] = (),
    type_: str = INDICATOR_PAYLOAD,
) -> DataFrame:
    """{code: [{date, value}]} to (Year, Indicator, Value, position).

    Only all-digit dates count; a null value stays null. With ``indicators`` codes become column
    names and unknown codes are left out.
    """
    series = df.select(*keep, F.explode(F.from_json(F.col(payload), type_)).alias("code", "points"))
    points = series.select(*keep, "code", F.posexplode("points").alias("position", "point"))
    named = F.col("code")
    if indicators is not None:
        pairs = F.create_map(*(F.lit(x) for pair in indicators.items() for x in pair))
        named = F.try_element_at(pairs, F.col("code"))
    return points.where(F.col("point.date").rlike("^[0-9]+$")).select(
        *keep,
        F.col("point.date").cast("int").alias("Year"),
        named.alias("Indicator"),
        F.col("point.value").alias("Value"),
        "position",
    ).where(F.col("Indicator").isNotNull())


def sector_rows(
    df: DataFrame,
    payload: str = "payload",
    gases: tuple[str, ...] = k.GASES,
    keep: tuple[str, ...] = (),
    type_: str = SECTOR_PAYLOAD,
) -> DataFrame:
    """{data: [{sector, gas, source, emissions: [{year, value}]}]} to one row per point.

    ``item_pos`` and ``point_pos`` keep the payload order. Points without year (or year 0) or
    without value are skipped.
    """
    items = df.select(*keep, F.posexplode(F.from_json(F.col(payload), type_)["data"]).alias("item_pos", "item"))
    points = items.where(F.col("item.gas").isin(*gases)).select(
        *keep, "item_pos", "item", F.posexplode("item.emissions").alias("point_pos", "point")
    )
    return points.where((F.col("point.year") != 0) & F.col("point.value").isNotNull()).select(
        *keep,
        F.col("point.year").alias("Year"),
        F.col("item.sector").alias("Sector_Raw"),
        F.col("item.gas").alias("Gas"),
        F.col("item.source").alias("Source"),
        F.col("point.value").alias("Emissions_MtCO2e"),
        "item_pos",
        "point_pos",
    )


def map_sectors(
    df: DataFrame,
    raw: str = "Sector_Raw",
    mapping: dict[str, tuple[str, str, str]] = k.SECTOR_MAP,
    unmapped: tuple[str, str] = k.UNMAPPED_SECTOR,
) -> DataFrame:
    """Adds code, names and category; an unknown sector keeps its raw name under the default code."""
    pairs = []
    for name, (code, name_vi, category) in mapping.items():
        meta = F.struct(
            F.lit(code).alias("code"), F.lit(name_vi).alias("name_vi"), F.lit(category).alias("category")
        )
        pairs += [F.lit(name), meta]
    meta = F.try_element_at(F.create_map(*pairs), F.col(raw))
    return df.select(
        "*",
        F.coalesce(meta["code"], F.lit(unmapped[0])).alias("Sector_Code"),
        F.col(raw).alias("Sector_Name_EN"),
        F.coalesce(meta["name_vi"], F.col(raw)).alias("Sector_Name_VI"),
        F.coalesce(meta["category"], F.lit(unmapped[1])).alias("Sector_Category"),
    )


#: What makes Spark store the common fields of landed records as columns, and read a path of a record as one.
SHREDDING = {
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def land_records(df: DataFrame, path: str, record: str = "record") -> None:
    """Appends JSON texts as VARIANT rows: every field survives, also those that no schema knows yet.

    The fields that most records share are stored as typed columns within the record (the session's settings as in
    :data:`SHREDDING`, set here for the write). A text that is no JSON is kept in ``unparsed``.
    """
    spark = df.sparkSession
    parsed = F.try_parse_json(record)
    rows = df.select(
        *(c for c in df.columns if c != record),
        parsed.alias("record"),
        F.when(parsed.isNull(), F.col(record)).alias("unparsed"),
        F.current_timestamp().alias("Loaded_At"),
    )
    before = {name: spark.conf.get(name) for name in SHREDDING}
    try:
        for name, value in SHREDDING.items():
            spark.conf.set(name, value)
        rows.write.mode("append").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def landed_fields(spark: SparkSession, path: str, fields: dict[str, tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of landed records as columns: name to (path, type). Only the paths that a query uses are read from the files.

    A record without the path, or with a value that does not fit the type, has NULL; a field whose type changed on the
    way (a number that became text, say) is cast where it can be. Set :data:`SHREDDING` in the session, so that paths are
    pushed into the scan.
    """
    rows = spark.read.parquet(path)
    return rows.select(*keep, *(F.try_variant_get("record", at, kind).alias(name) for name, (at, kind) in fields.items()))
