"""CSV in and out. Cells are read as text and typed by explicit rules, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from ..functions.text import code_key


#: Quoted cells with doubled quotes inside, in and out.
QUOTING = {"quote": '"', "escape": '"'}


def typed(cell: Column, dtype, blank=None) -> Column:
    """A text cell as ``dtype``; a blank one becomes ``blank``; a flag is true only when it is '1'."""
    if isinstance(dtype, StringType):
        return cell
    if isinstance(dtype, BooleanType):
        return F.coalesce(F.trim(cell) == "1", F.lit(False))
    value = F.when(F.trim(cell) != "", F.trim(cell).cast(dtype))
    return value if blank is None else F.coalesce(value, F.lit(blank).cast(dtype))


def unfit(cell: Column, dtype: str) -> Column:
    """Whether a cell that is not blank does not fit its type, as a number of too many digits: such cells are reported, not taken as
    blank."""
    return (F.trim(cell) != "") & F.trim(cell).try_cast(dtype).isNull()


def apply_schema(df: DataFrame, ddl: str, blanks: dict[str, object] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    schema = StructType.fromDDL(ddl)
    blanks = blanks or {}
    return df.select(*(typed(F.col(f.name), f.dataType, blanks.get(f.name)).alias(f.name) for f in schema), *keep)


def normalise_codes(df: DataFrame) -> DataFrame:
    """Code columns in upper case and trimmed, so that they compare as under a case-blind collation."""
    return df.withColumns({c: code_key(F.col(c)) for c in df.columns if c.endswith("_Code")})


def read_csv(
    spark: SparkSession, path: str, ddl: str, blanks: dict[str, object] | None = None, line_ends_in_cells: bool = False
) -> DataFrame:
    """UTF-8 with or without BOM; columns are found by their header name.

    Large files are read in splits. A file whose quoted cells hold line ends must be read whole by one task, so that is for
    the caller to say; without it such a cell is cut, and its row is short.
    """
    reader = spark.read.options(header=True, multiLine=line_ends_in_cells, **QUOTING)
    return normalise_codes(apply_schema(reader.csv(path), ddl, blanks))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **QUOTING).csv(path)


def parse_cells(lines: DataFrame, line: str, names: list[str]) -> DataFrame:
    """Lines of quoted CSV as text columns, under the same options as the reader."""
    ddl = ", ".join(f"`{n}` string" for n in names)
    return lines.withColumn("_cells", F.from_csv(line, ddl, QUOTING)).select(
        *(c for c in lines.columns if c != line), *(F.col("_cells").getField(n).alias(n) for n in names)
    )


def split_fields(lines: DataFrame, line: str, names: list[str], sep: str = ",") -> DataFrame:
    """Lines cut at ``sep`` without quoting: the first fields by name and ``enough_fields``.

    Lines with more fields keep the first ones; those with fewer are marked for
    :func:`drop_short`.
    """
    fields = F.split(F.col(line), sep, -1)
    return lines.withColumn("_fields", fields).select(
        *lines.columns,
        *(F.get(F.col("_fields"), i).alias(name) for i, name in enumerate(names)),
        (F.size("_fields") >= len(names)).alias("enough_fields"),
    )


def drop_short(split: DataFrame) -> DataFrame:
    return split.where("enough_fields").drop("enough_fields")


def line_counts() -> list[Column]:
    """(kept, dropped) line counts as aggregates over split lines, for the audit trail."""
    return [F.count_if("enough_fields").alias("kept"), F.count_if(~F.col("enough_fields")).alias("dropped")]


def bulk_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Split lines of a bulk file (header lines left out), still with ``enough_fields``."""
    return split_bulk(spark.read.text(path), ddl)


def split_bulk(lines: DataFrame, ddl: str) -> DataFrame:
    names = StructType.fromDDL(ddl).names
    data = lines.where(F.ltrim(F.col("value"), F.lit("\ufeff")) != ",".join(names))
    return split_fields(data, "value", names).drop("value")


def typed_rows(split: DataFrame, ddl: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of split lines: blank numbers are 0, a value that does not fit its type fails the load."""
    numbers = {f.name: 0 for f in StructType.fromDDL(ddl) if isinstance(f.dataType, NumericType)}
    return normalise_codes(apply_schema(drop_short(split), ddl, numbers, keep))


def bulk_load(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return typed_rows(bulk_lines(spark, path, ddl), ddl)
