"""Load jobs over a warehouse folder of Parquet tables.

Every job can be run again after any failure: staging is overwritten, dimensions are merged by natural key into
a new version, facts replace the slices of the years that are staged and are published as snapshots, each in one step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import constants as k
from ..operators import profiles, quality
from ..operators.audit import RUNNING, audit_state
from ..operators.constraints import Rule, non_negative, percentage, positive, required
from ..operators.generators import dim_date, dim_time_of_day, sector_seed
from ..operators.lookup import lookup_losses
from ..operators.merge import scd1_merge
from ..sources import csvfiles, schemas, snapshots
from ..sources.tables import (
    exists,
    publish_dimension,
    published,
    remember_schema,
    remove,
    remembered_schema,
    stage_overwrite,
    truncate,
)
from ..streaming import hourly_feed
from . import cuboids, facts, measures, views

STAGING = ("national", "sectors", "provincial", "provinces", "stations", "hourly")
YEARLY_STAGING = STAGING[:4]
PROVINCE_COLUMNS = ["Province_Name", "Province_Name_Ascii", "Region", "Economic_Zone", "Area_Km2", "Is_Industrial_Hub"]
SECTOR_COLUMNS = ["Sector_Name_EN", "Sector_Name_VI", "Sector_Category"]
STATION_COLUMNS = ["Station_Name", "Province_Key", "Station_Type", "Latitude", "Longitude", "Is_Active"]
#: Slices of each fact: what a load replaces, and what a filter prunes.
FACTS = {"fact_national": ("Date_Key",), "fact_provincial": ("Date_Key",), "fact_hourly": hourly_feed.MONTHS}
FACT_SPECS = {
    "fact_national": profiles.Spec(
        "fact_national", ("Sector_Key", "Emissions_MtCO2e"), ("Emissions_MtCO2e",), tuple(facts.NATIONAL_RULES), ("Date_Key", "Emission_ID")
    ),
    "fact_provincial": profiles.Spec(
        "fact_provincial", ("Province_Key", *facts.PROVINCIAL_MEASURES), facts.PROVINCIAL_MEASURES, tuple(facts.PROVINCIAL_RULES), ("Date_Key", "Economy_ID")
    ),
    "fact_hourly": profiles.Spec(
        "fact_hourly", ("Station_Key", "AQI_Index", *facts.READINGS), facts.READINGS, tuple(facts.HOURLY_RULES), (*hourly_feed.MONTHS, "Monitoring_ID")
    ),
}
HOURLY_STAR = ["fact_hourly", "dim_date", "dim_time_of_day", "dim_province", "dim_station"]
AUDIT = (
    "event_id string, log_id string, package string, task string, status string, rows_processed bigint, "
    "error string, at timestamp"
)
DIMENSIONS = {
    "dim_date": "Date_Key int, Year int, Decade string, Five_Year_Plan_Phase string, Is_Target_Milestone boolean",
    "dim_time_of_day": "Time_Key int, Hour_24 smallint, Hour_Label string, Time_Bucket string, Is_Rush_Hour boolean",
    "dim_province": "Province_Key bigint, " + schemas.PROVINCES,
    "dim_sector": "Sector_Key bigint, Sector_Code string, Sector_Name_EN string, Sector_Name_VI string, "
    "Sector_Category string, Scope_Type string",
    "dim_station": "Station_Key bigint, Station_Code string, Station_Name string, Province_Key bigint, "
    "Station_Type string, Latitude decimal(9,6), Longitude decimal(9,6), Is_Active boolean",
}
#: Beside the natural and surrogate keys, which are checked for NULLs and duplicates in every version.
DIMENSION_RULES = {
    "dim_province": [non_negative("Area_Km2"), *(required(c) for c in PROVINCE_COLUMNS)],
    "dim_sector": [required(c) for c in SECTOR_COLUMNS],
    "dim_station": [required(c) for c in STATION_COLUMNS],
}


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """A table under its known schema, so that opening it runs no job."""
        if table in DIMENSIONS:
            path = published(self.spark, self.path(table))
            if path is None:
                raise FileNotFoundError(f"{table} is not loaded yet")
            return self.spark.read.schema(DIMENSIONS[table]).parquet(path)
        if table in FACTS:
            return snapshots.read(self.spark, self.path(table))
        schema = remembered_schema(self.spark, self.path(table))
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(table))

    def has(self, table: str) -> bool:
        if table in DIMENSIONS:
            return published(self.spark, self.path(table)) is not None
        if table in FACTS:
            return snapshots.snapshot(self.spark, self.path(table)) is not None
        return exists(self.spark, self.path(table))

    def publish(self, table: str, df: DataFrame, key: str, natural: str | None = None, rules: Sequence[Rule] = ()) -> None:
        """The dimension under its declared types, as a new version."""
        wanted = StructType.fromDDL(DIMENSIONS[table])
        typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))
        publish_dimension(self.spark, typed, self.path(table), key, natural, rules)

    def dimension(self, table: str) -> DataFrame:
        """The dimension, empty before its first load."""
        if self.has(table):
            return self.read(table)
        return self.spark.createDataFrame([], DIMENSIONS[table])

    # --- audit ---------------------------------------------------------------
    def log(
        self,
        package: str,
        status: str,
        task: str | None = None,
        log_id: str | None = None,
        rows: int | None = None,
        error: str | None = None,
    ) -> str:
        """Appends one event and returns the id of its run."""
        import uuid

        event = uuid.uuid4().hex
        run = event if status == RUNNING else log_id
        row = [(event, run, package, task, status, rows, error)]
        ddl = AUDIT.rsplit(",", 1)[0]
        events = self.spark.createDataFrame(row, ddl).withColumn("at", F.current_timestamp())
        events.write.mode("append").parquet(self.path("audit_events"))
        return run or event

    def audit(self) -> DataFrame:
        return audit_state(self._events())

    def _events(self) -> DataFrame:
        """All events: the archived ones and those since; one that a stopped compaction left in both counts once."""
        names = [part.split()[0] for part in AUDIT.split(", ")]
        archive = self.path("audit_archive")
        if snapshots.snapshot(self.spark, archive) is None:
            return self.read("audit_events").select(*names)
        events = snapshots.read(self.spark, archive).select(*names)
        if self.has("audit_events"):
            events = events.unionByName(self.spark.read.schema(AUDIT).parquet(self.path("audit_events")).select(*names))
        return events.dropDuplicates(["event_id"])

    def compact_audit(self) -> int:
        """Moves the events, a small file each, into an archive by month; the number of files it has taken.

        The archive is published before a file goes, and an event has an id, so a run that is stopped loses and doubles none;
        files that come meanwhile are left.
        """
        if not self.has("audit_events"):
            return 0
        files = self.spark.read.schema(AUDIT).parquet(self.path("audit_events")).inputFiles()
        if not files:
            return 0
        events = self.spark.read.schema(AUDIT).parquet(*files).withColumn("Month", F.date_format("at", "yyyy-MM"))
        snapshots.upsert(events, self.path("audit_archive"), ["Month"], "event_id", F.col("at"))
        remove(self.spark, files)
        return len(files)

    # --- staging ---------------------------------------------------------------
    def truncate_staging(self) -> None:
        for name in YEARLY_STAGING:
            if self.has(f"staging/{name}"):
                truncate(self.spark, self.path(f"staging/{name}"))

    def stage(self, name: str, df: DataFrame, source: str) -> None:
        stage_overwrite(df, self.path(f"staging/{name}"), source)

    def staged(self, name: str) -> DataFrame:
        return self.read(f"staging/{name}").drop("Loaded_At", "Source_File")

    def stage_csv(self, name: str, path: str) -> None:
        ddl, blanks = {
            "national": (schemas.NATIONAL, None),
            "sectors": (schemas.SECTORS, None),
            "provincial": (schemas.PROVINCIAL, schemas.PROVINCIAL_BLANKS),
            "provinces": (schemas.PROVINCES, schemas.PROVINCE_BLANKS),
            "stations": (schemas.STATIONS, None),
        }[name]
        # these files are small, and read whole in case a cell holds a line end
        self.stage(name, csvfiles.read_csv(self.spark, path, ddl, blanks, line_ends_in_cells=True), path.rsplit("/", 1)[-1])

    def stage_hourly(self, path: str) -> dict[str, int]:
        """Bulk-loads readings; returns the kept and dropped line counts, taken in the same pass."""
        seen = Observation()
        split = csvfiles.bulk_lines(self.spark, path, schemas.HOURLY).observe(seen, *csvfiles.line_counts())
        rows = csvfiles.typed_rows(split, schemas.HOURLY)
        rows.write.mode("overwrite").parquet(self.path("staging/hourly"))
        remember_schema(self.spark, self.path("staging/hourly"), rows.schema)
        return seen.get

    # --- dimensions ----------------------------------------------------------------
    def seed_dimensions(self) -> None:
        dates = dim_date(self.spark)
        if self.has("dim_date"):
            known = self.read("dim_date")
            dates = known.join(dates, "Date_Key", "left_anti").unionByName(dates)
        self.publish("dim_date", dates, "Date_Key", "Year")
        self.publish("dim_time_of_day", dim_time_of_day(self.spark), "Time_Key", "Hour_24")
        self._merge("dim_sector", sector_seed(self.spark), "Sector_Code", [*SECTOR_COLUMNS, "Scope_Type"], "Sector_Key")
        if self.has("staging/provinces"):
            self.load_provinces()

    def _merge(self, table: str, source: DataFrame, key: str, columns: list[str], surrogate: str, **options) -> None:
        """Merges and publishes; an empty source leaves the table alone."""
        if source.isEmpty():
            return
        target = self.dimension(table)
        merged = scd1_merge(target, source, key, columns, surrogate, **options)
        self.publish(table, merged, surrogate, key, DIMENSION_RULES.get(table, ()))

    def load_provinces(self) -> None:
        self._merge(
            "dim_province",
            self.staged("provinces"),
            "Province_Code",
            PROVINCE_COLUMNS,
            "Province_Key",
            keep_if_null=["Area_Km2", "Is_Industrial_Hub"],
            insert_default={"Area_Km2": 0, "Is_Industrial_Hub": False},
        )

    def load_sectors(self) -> None:
        """Codes and names found in staging; the scope of known sectors stays."""
        found = self.staged("sectors").select("Sector_Code", *SECTOR_COLUMNS).where(F.col("Sector_Code").isNotNull())
        self._merge("dim_sector", found.distinct(), "Sector_Code", SECTOR_COLUMNS, "Sector_Key")

    def load_dimensions(self) -> None:
        self.load_provinces()
        self.load_sectors()

    def load_stations(self) -> None:
        rows = facts.station_rows(self.staged("stations"), self.read("dim_province"))
        self._merge("dim_station", rows, "Station_Code", STATION_COLUMNS, "Station_Key")

    # --- facts -----------------------------------------------------------------------
    def publish_fact(self, table: str, rows: DataFrame, staged: DataFrame, rules: list[Rule], key: str, layout=snapshots.Layout()) -> None:
        """One snapshot in which all slices of the staged years are ``rows``."""
        years = snapshots.staged_slices(staged, ["Date_Key"])
        snapshots.replace(rows, self.path(table), FACTS[table], years, rules, key, layout)

    def load_yearly_facts(self) -> None:
        dates = self.read("dim_date")
        national = facts.national_fact(
            self.staged("sectors"), dates, self.read("dim_sector"), self.staged("national")
        )
        years = self.staged("sectors").select(F.col("Year").alias("Date_Key"))
        self.publish_fact("fact_national", national, years, facts.NATIONAL_RULES, "Emission_ID")
        provincial = facts.provincial_fact(self.staged("provincial"), dates, self.read("dim_province"))
        years = self.staged("provincial").select(F.col("Year").alias("Date_Key"))
        self.publish_fact("fact_provincial", provincial, years, facts.PROVINCIAL_RULES, "Economy_ID")

    def hourly_rows(self, readings: DataFrame, keep: Sequence[str] = ("Month", "Day")) -> DataFrame:
        dims = (self.read(table) for table in ("dim_date", "dim_time_of_day", "dim_province", "dim_station"))
        return facts.hourly_fact(readings, *dims, keep=tuple(keep))

    def hourly_layout(self) -> snapshots.Layout:
        """Rows of a month by station and day, with a Bloom filter for stations."""
        last = self.read("dim_station").agg(F.max("Station_Key").alias("last")).first().last or 1
        return snapshots.Layout(cluster=(("Station_Key", 1, last), ("Day", 1, 31)), bloom=("Station_Key",), bloom_values=last)

    def load_hourly_fact(self) -> None:
        staged = self.staged("hourly")
        self.publish_fact("fact_hourly", self.hourly_rows(staged), staged, facts.HOURLY_RULES, "Monitoring_ID", self.hourly_layout())

    def stream_hourly(self, folder: str, checkpoint: str, **options):
        """Readings from files as they arrive, upserted into the fact; see :func:`hourly_feed.load_fact`."""
        readings = hourly_feed.readings_stream(self.spark, folder, files_per_batch=options.pop("files_per_batch", hourly_feed.FILES_PER_BATCH), arrival=True)

        return hourly_feed.load_fact(
            readings,
            lambda batch: self.hourly_rows(batch, ("Month", "Day", "Arrived_At")),
            self.path("fact_hourly"),
            checkpoint,
            rules=facts.HOURLY_RULES,
            layout=self.hourly_layout,
            unmatched=self.unmatched_readings,
            **options,
        )

    def unmatched_readings(self, readings: DataFrame) -> DataFrame:
        """The readings that some lookup of the fact would lose."""
        found = readings
        for table, key in (("dim_date", "Date_Key"), ("dim_time_of_day", "Hour_24"), ("dim_province", "Province_Code"), ("dim_station", "Station_Code")):
            known = self.read(table).select(F.col(key).alias("_known")).distinct()
            found = found.join(known, found[key] == known["_known"], "left").withColumn(f"_has_{key}", F.col("_known").isNotNull()).drop("_known")
        flags = [c for c in found.columns if c.startswith("_has_")]
        all_known = F.lit(True)
        for flag in flags:
            all_known = all_known & F.col(flag)
        return found.where(~all_known).drop(*flags)

    def expire(self, keep: int = 2) -> None:
        """Deletes what only older snapshots of the facts show."""
        for table in FACTS:
            if self.has(table):
                snapshots.expire(self.spark, self.path(table), keep)

    def orphans(self) -> DataFrame:
        """(fact, lookup, rows_lost): staged rows that each inner lookup would lose, for the tables that are staged."""
        dates, provinces = (self.read("dim_date"), "Year", "Year"), (self.read("dim_province"), "Province_Code", "Province_Code")
        lookups = {
            "provincial": {"date": dates, "province": provinces},
            "sectors": {"date": dates, "sector": (self.read("dim_sector"), "Sector_Code", "Sector_Code")},
        }
        if self.has("staging/hourly") and self.has("dim_station"):
            lookups["hourly"] = {
                "date": (self.read("dim_date"), "Date_Key", "Date_Key"),
                "hour": (self.read("dim_time_of_day"), "Hour_24", "Hour_24"),
                "province": provinces,
                "station": (self.read("dim_station"), "Station_Code", "Station_Code"),
            }
        return quality.union_all(
            [lookup_losses(self.staged(name), by).select(F.lit(name).alias("fact"), "lookup", "rows_lost") for name, by in lookups.items()]
        )

    def log_losses(self, package: str, facts_: Sequence[str]) -> None:
        """One finished entry per lookup that loses rows."""
        for row in self.orphans().where(F.col("fact").isin(*facts_) & (F.col("rows_lost") > 0)).collect():
            self.log(package, "WARNING", f"{row.fact}: rows lost by {row.lookup}", rows=row.rows_lost)

    def run(self, package: str, task: str, job, table: str | None = None) -> None:
        """Runs one job with its audit trail; the row count of ``table`` goes into it."""
        run = self.log(package, RUNNING, task)
        try:
            job()
        except Exception as error:
            self.log(package, "FAILED", task, run, error=str(error))
            raise
        rows = self.read(table).count() if table else None
        self.log(package, "SUCCESS", task, run, rows)

    def load_yearly(self) -> None:
        """Dimensions, then facts, with audit."""
        self.run("dimensions", "provinces and sectors", self.load_dimensions)
        self.run("facts", "national and provincial", self.load_yearly_facts, "fact_provincial")
        self.log_losses("facts", ("provincial", "sectors"))

    def load_hourly(self, path: str) -> None:
        """Readings from a bulk file to the fact, with audit; dropped lines and lost rows go into the trail."""
        counts: dict[str, int] = {}
        self.run("hourly", "staging", lambda: counts.update(self.stage_hourly(path)))
        if counts["dropped"]:
            self.log("hourly", "WARNING", "lines with too few fields", rows=counts["dropped"])
        self.run("hourly", "fact", self.load_hourly_fact, "fact_hourly")
        self.log_losses("hourly", ("hourly",))

    # --- views -------------------------------------------------------------------------
    def view(self, name: str) -> DataFrame:
        """One of the report views over the loaded tables."""
        build = {
            "vw_dim_date": (views.vw_dim_date, ["dim_date"]),
            "vw_dim_time_of_day": (views.vw_dim_time_of_day, ["dim_time_of_day"]),
            "vw_dim_province": (views.vw_dim_province, ["dim_province"]),
            "vw_dim_sector": (views.vw_dim_sector, ["dim_sector"]),
            "vw_dim_station": (views.vw_dim_station, ["dim_station", "dim_province"]),
            "vw_fact_national": (views.vw_fact_national, ["fact_national", "dim_date", "dim_sector"]),
            "vw_fact_provincial": (views.vw_fact_provincial, ["fact_provincial", "dim_date", "dim_province"]),
            "vw_fact_hourly": (views.vw_fact_hourly, HOURLY_STAR),
        }
        function, tables = build[name]
        return function(*(self.read(table) for table in tables))

    def _sums_of(self) -> dict[str, object]:
        """What stored sums must be of: the versions of the star's tables."""
        fact = snapshots.snapshot(self.spark, self.path("fact_hourly"))
        return {"fact_hourly": fact.version if fact else 0} | {t: published(self.spark, self.path(t)) for t in HOURLY_STAR[1:]}

    def store_air_sums(self, grains: Sequence[Sequence[str]]) -> None:
        """Sums of the air measures at several grains, from one scan of the fact; good until it or a dimension changes."""
        rows = cuboids.star_rows(*(self.read(table) for table in HOURLY_STAR))
        cuboids.store(rows, self.path("air_sums"), [tuple(g) for g in grains], self._sums_of())

    def air_measures(self, by: list[str]) -> DataFrame:
        """From stored sums where they are of the present tables and fine enough, else from the star."""
        stored = cuboids.answer(self.spark, self.path("air_sums"), self._sums_of(), by)
        return stored if stored is not None else measures.air_measures(*(self.read(table) for table in HOURLY_STAR), by=by)

    # --- quality gate ----------------------------------------------------------------------
    def findings(self, required_years=k.REQUIRED_YEARS, provinces: int = k.PROVINCE_COUNT) -> DataFrame:
        national, sectors = self.staged("national"), self.staged("sectors")
        economy, places = self.staged("provincial"), self.staged("provinces")
        year = F.col("Year")
        coverage = quality.year_coverage(
            {"national": (national, year), "sectors": (sectors, year), "provincial": (economy, year)}
        )
        positives = [positive(c, null_ok=False) for c in ("GRDP_Billion_VND", "Population", "Estimated_Carbon_Tonnes")]
        keys = {
            "national": (national, ["Year"]),
            "sectors": (sectors, ["Year", "Sector_Code", "Gas"]),
            "provincial": (economy, ["Year", "Province_Code"]),
            "provinces": (places, ["Province_Code"]),
        }
        return quality.gate_rows(
            profiled=[
                quality.profile(
                    national,
                    "national",
                    ["Year", "CO2_MtCO2e", "Total_GHG_MtCO2e", "Methane_MtCO2e"],
                    [non_negative("CO2_MtCO2e"), non_negative("Total_GHG_MtCO2e")],
                ),
                quality.profile(
                    sectors,
                    "sectors",
                    ["Year", "Sector_Code", "Gas", "Emissions_MtCO2e"],
                    [non_negative("Emissions_MtCO2e")],
                ),
                quality.profile(
                    economy,
                    "provincial",
                    ["Year", "Province_Code", "GRDP_Billion_VND", "Population", "Estimated_Carbon_Tonnes"],
                    [*positives, percentage("Forest_Coverage_Pct", null_ok=False)],
                ),
                quality.profile(
                    places, "provinces", ["Province_Code", "Province_Name", "Region", "Economic_Zone", "Area_Km2"]
                ),
            ],
            consistent=[quality.year_consistency(coverage, required_years)],
            referential=[quality.reference_counts(economy, "Province_Code", places, "Province_Code", provinces)],
            unique=[quality.uniqueness(df, name, key) for name, (df, key) in keys.items()],
        )

    def fact_findings(self, table: str) -> DataFrame:
        """Completeness, rules and doubled keys of a loaded fact; only slices that changed since the last time are read."""
        spec = FACT_SPECS[table]
        profiles.refresh(self.spark, self.path(table), self.path("profiles"), spec)
        return profiles.findings(self.spark, self.path(table), self.path("profiles"), spec)

    def gate(self, **options) -> DataFrame:
        return quality.gate(self.findings(**options))
