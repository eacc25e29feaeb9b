"""The whole star build (F3): raw files → conformed dimensions, facts, log, key checks.

Plain Python calling the operators; each step is a DataFrame plan. Inputs have
the layout of the source project's data folder:

* ``agencies.csv``, ``crime_incidents.csv`` (header line, columns by position)
* ``meteodata/weather_stations.csv`` and one wide CSV per parameter
* ``auxfs/station_names.csv`` (no header) and ``auxfs/meteoparam_names_fmts.csv``

Outputs go under ``out_root``: ``stage/`` (quarantine tables, cleaned events,
log) and ``mart/`` (dimensions and facts).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from asterism.operators import events as ev
from asterism.operators import facts, generators, quality, reshape, schema
from asterism.sources import csv as csv_src
from asterism.sources import load, sinks
from asterism.sources.store import Store

# The columns of the source files, by position (VARCHAR(n) → STRING,
# FLOAT → DOUBLE, TIMESTAMP → TIMESTAMP_NTZ).
AGENCIES_SCHEMA = (
    "ori STRING, agency STRING, agency_type STRING, state STRING, state_abbr STRING, "
    "division STRING, region STRING, region_desc STRING, county STRING, nibrs BOOLEAN, "
    "ori_lat DOUBLE, ori_long DOUBLE, nibrs_start_date TIMESTAMP_NTZ")
STATIONS_SCHEMA = "stn_city STRING, stn_country STRING, stn_lat DOUBLE, stn_long DOUBLE"
INCIDENTS_SCHEMA = (
    "incident_id_orig BIGINT, data_year INT, ori STRING, pub_agency_name STRING, pub_agency_unit STRING, "
    "agency_type_name STRING, state_abbr STRING, state_name STRING, division_name STRING, "
    "region_name STRING, population_group_code STRING, population_group_desc STRING, "
    "incident_date TIMESTAMP_NTZ, adult_victim_count INT, juvenile_victim_count INT, "
    "total_offender_count INT, adult_offender_count INT, juvenile_offender_count INT, "
    "offender_race STRING, offender_ethnicity STRING, victim_count INT, offenses STRING, "
    "total_individual_victims INT, location_name STRING, bias_desc STRING, victim_types STRING, "
    "multiple_offense STRING, multiple_bias STRING")
SPECS_SCHEMA = "tbl_name STRING, col_fmt STRING"

# The incident columns kept for the event table (the others repeat
# agency data, or are dropped by the source design: incident_id_orig, data_year,
# pub_agency_unit).
INCIDENT_KEEP = [
    "ori", "population_group_code", "population_group_desc", "incident_date",
    "adult_victim_count", "juvenile_victim_count", "total_offender_count",
    "adult_offender_count", "juvenile_offender_count", "offender_race",
    "offender_ethnicity", "victim_count", "offenses", "total_individual_victims",
    "location_name", "bias_desc", "victim_types", "multiple_offense", "multiple_bias"]

# The declared sort keys of the published dimensions.
DIMENSION_SORT_KEYS = {
    "dim_agencies": ["ori_lat", "ori_long"],
    "dim_weather_stations": ["stn_country", "stn_city"],
    "dim_dates": ["date"],
    "dim_hours": ["hour"],
}

# Declared string lengths checked by V4.
AGENCY_LENGTHS = {"ori": 9, "agency": 100, "agency_type": 100, "state": 50, "state_abbr": 2,
                  "division": 150, "region": 150, "region_desc": 150, "county": 150}
STATION_LENGTHS = {"stn_city": 100, "stn_country": 100}
SPEC_LENGTHS = {"tbl_name": 64, "col_fmt": 64}
INCIDENT_LENGTHS = {"ori": 9, "population_group_code": 200, "population_group_desc": 150,
                    "offender_race": 200, "offender_ethnicity": 500, "offenses": 800,
                    "location_name": 500, "bias_desc": 800, "victim_types": 500,
                    "multiple_offense": 20, "multiple_bias": 20}


#: A build makes all tables anew: it refuses to replace any, or replaces them one by one, or
#: writes them beside the earlier ones and makes them seen all at once (see ``sources.store``).
BUILD_MODES = ("errorifexists", "overwrite", "versioned")


@dataclass
class StarConfig:
    data_root: str
    out_root: str
    mode: str = "errorifexists"
    start_not_later: str | None = None
    end_not_earlier: str | None = None
    assume_unique_measures: bool | None = None
    check_headers: bool = False
    empty_strings: str = "null"
    scale_mode: str = "round"
    timestamp_format: str | None = None
    multi_line: bool = False
    manifest: str | None = None
    max_errors: int | None = None
    stage: str = "stage"
    mart: str = "mart"

    def __post_init__(self):
        if self.mode not in BUILD_MODES:
            raise ValueError(f"mode must be one of {BUILD_MODES}")

    @property
    def csv_options(self) -> dict:
        return {"empty_strings": self.empty_strings, "scale_mode": self.scale_mode,
                "timestamp_format": self.timestamp_format, "multi_line": self.multi_line}


# The inputs that every build has; the specs name the wide measure files.
INPUTS = ("agencies.csv", "crime_incidents.csv", "meteodata/weather_stations.csv", "auxfs/station_names.csv",
          "auxfs/meteoparam_names_fmts.csv")


@dataclass
class Inputs:
    """Where a build's files lie, and its loads so far: in the layout above, or as a manifest maps it."""

    spark: SparkSession
    cfg: StarConfig
    paths: Mapping[str, str] | None = None
    loads: dict[str, load.Load] = field(default_factory=dict)

    def __post_init__(self):
        if self.cfg.manifest is not None and self.paths is None:
            pairs = csv_src.read_manifest(self.spark, self.cfg.manifest)
            self.paths = load.manifest_paths(self.spark, pairs, self.cfg.data_root, INPUTS)

    def path(self, name: str) -> str:
        if self.paths is None:
            return f"{self.cfg.data_root.rstrip('/')}/{name}"
        if name not in self.paths:
            raise ValueError(f"not in the manifest: {name}")
        return self.paths[name]

    def read(self, name: str, schema: StructType | str, stored: str | None = None) -> DataFrame:
        """The rows of an input; with ``max_errors`` set, its good rows, the bad ones being kept in ``loads``."""
        if self.cfg.max_errors is None:
            return csv_src.read_positional_csv(self.spark, self.path(name), schema, **self.cfg.csv_options)
        options = {k: v for k, v in self.cfg.csv_options.items() if k != "multi_line"}
        self.loads[name] = load.load_csv(self.spark, self.path(name), schema, self.cfg.max_errors, stored, **options)
        return self.loads[name].rows

    def errors(self) -> DataFrame:
        """What is wrong with the bad rows of all loads, by input."""
        return reduce(DataFrame.unionByName, [x.errors.select(F.lit(name).alias("input"), "*") for name, x in self.loads.items()])

    def log(self) -> list[DataFrame]:
        """A log row for each file loaded."""
        message = F.concat(F.col("n_rows").cast("string"), F.lit(" rows loaded, "), F.col("n_bad").cast("string"),
                           F.lit(" rejected from "), F.col("file"))
        return [x.by_file().select(F.lit(self.cfg.stage).alias("schema_name"), F.lit(name).alias("table_name"),
                                   message.alias("message"), F.localtimestamp().alias("dt")) for name, x in self.loads.items()]


@dataclass
class Star:
    """Every table of the build, as DataFrames (written already when ``write=True``)."""

    tables: dict[str, DataFrame]
    log: DataFrame
    checks: dict[str, DataFrame]
    written: dict[str, str] = field(default_factory=dict)  # folders of the stored tables, under the root


def _path(cfg: StarConfig, area: str, name: str) -> str:
    return f"{cfg.out_root.rstrip('/')}/{area}/{name}"


def _read_specs(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    return (csv_src.read_positional_csv(inputs.spark, inputs.path("auxfs/meteoparam_names_fmts.csv"), SPECS_SCHEMA),
            csv_src.read_ordered_names(inputs.spark, inputs.path("auxfs/station_names.csv")))


def load_measures(spark: SparkSession, cfg: StarConfig,
                  staged: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
                  inputs: Inputs | None = None) -> tuple[DataFrame, list[str]]:
    """Specs → schemas → wide files → long tables → one combined measure table.

    ``staged`` stores each long table, so that the raw file is read once for it.
    """
    inputs = inputs or Inputs(spark, cfg)
    schemas = schema.measure_schemas(*_read_specs(inputs))
    names = [f.name for f in next(iter(schemas.values())).fields[1:]] if schemas else []
    longs = {}
    for param, struct in schemas.items():
        # Values bind by position: a file with another number of stations would
        # label every value with the wrong station, so that always fails; the
        # names themselves may be renamed in the spec and are checked on request.
        header = csv_src.csv_header(spark, inputs.path(f"meteodata/{param}.csv"))
        if len(header) != len(names) + 1:
            raise ValueError(f"{param}.csv has {len(header) - 1} station columns, the spec lists {len(names)}")
        if cfg.check_headers and [h.lower() for h in header[1:]] != [n.lower() for n in names]:
            raise ValueError(f"{param}.csv station columns {header[1:]} differ from the spec {names}")
        wide = inputs.read(f"meteodata/{param}.csv", struct)
        longs[param] = staged(reshape.unpivot_measures(wide, ["datetime"], names, "stn", param), f"long_{param}")
    unique = cfg.assume_unique_measures
    if unique is None:
        # Each wide row gives one long row per station, so (datetime, stn) is unique
        # if datetime is among the rows of one station. Then the combine runs as one
        # aggregate instead of a chain of joins.
        unique = all(_unique_non_null(long.where(F.col("stn") == names[0]), "datetime") for long in longs.values())
    return reshape.full_join_measures(longs, ["datetime", "stn"], unique), names


def _unique_non_null(df: DataFrame, col: str) -> bool:
    repeated = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1))
    return repeated.isEmpty()


def build_star(spark: SparkSession, cfg: StarConfig, write: bool = True) -> Star:
    """Build every table (see :func:`_build`).

    ``mode="versioned"`` writes into a version folder and commits all tables together when
    the last is written: until then, and if the build fails or is killed, readers of
    ``Store(spark, out_root)`` see the earlier star. The log goes on from commit to commit.
    """
    if not write or cfg.mode != "versioned":
        return _build(spark, cfg, write)
    with Store(spark, cfg.out_root).change() as change:
        star = _build(spark, replace(cfg, out_root=f"{change.store.root}/{change.folder}", mode="errorifexists"), write)
        for name, folder in star.written.items():
            earlier = change.tables.get(name, []) if name == "log_table" else []
            change.tables[name] = [*earlier, f"{change.folder}/{folder}"]
    return star


def _drop_runs(spark: SparkSession, cfg: StarConfig, but: str) -> None:
    """Remove what earlier builds stored on their way: their tables have just been replaced."""
    stage = spark._jvm.org.apache.hadoop.fs.Path(_path(cfg, cfg.stage, ""))
    fs = stage.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(stage):
        if status.getPath().getName().startswith("run-") and status.getPath().getName() != but:
            fs.delete(status.getPath(), True)


def _build(spark: SparkSession, cfg: StarConfig, write: bool) -> Star:
    """Build every table. With ``write=True`` the intermediate tables that are used
    more than once (distinct dimension rows, the long measures, the combined
    measures) are stored in a folder of this run under the stage area and read
    back, so each raw input is read once for its rows and nothing of an earlier run
    is ever read; the cleaned incidents are stored by their id layout. Key checks
    are bound to the tables written, not to the plans that made them."""
    inputs = Inputs(spark, cfg)
    read = inputs.read
    run = f"run-{uuid.uuid4().hex}"
    stage_path = (lambda name: _path(cfg, cfg.stage, f"{run}/{name}")) if write else (lambda name: None)

    def staged(df: DataFrame, name: str, sort: str | None = None) -> DataFrame:
        if not write:
            return df
        sinks.write_table(df.sortWithinPartitions(sort) if sort else df, stage_path(name))
        return spark.read.parquet(stage_path(name))

    logs: list[DataFrame] = []

    agencies = quality.conform_dimension(read("agencies.csv", AGENCIES_SCHEMA), ["ori"],
                                         copies_path=stage_path("agencies_distinct"))
    logs.append(quality.audit_rows(agencies.audit, cfg.stage, "agencies"))

    ws_raw = read("meteodata/weather_stations.csv", STATIONS_SCHEMA)
    stations = quality.conform_dimension(ws_raw, ["stn_lat", "stn_long"],
                                         copies_path=stage_path("weather_stations_distinct"))
    logs.append(quality.audit_rows(stations.audit, cfg.stage, "weather_stations"))
    dim_stations = quality.add_slug_key(stations.clean, "stn_city", "stn_name")

    incidents, incident_audit = ev.clean_events(read("crime_incidents.csv", INCIDENTS_SCHEMA),
                                                INCIDENT_KEEP, date_col="incident_date")
    logs.append(quality.audit_rows(incident_audit, cfg.stage, "crime_incidents"))
    vocab = reshape.list_vocabulary(incidents, "offenses")
    names = reshape.split_to_rows(incidents, ["id"], "offenses")
    pivoted = reshape.pivot_counts(names, ["id", "name_cnt"], vocab=vocab)

    measures, _ = load_measures(spark, cfg, staged, inputs)
    # The long measure table is stored in datetime order (within each file).
    measures = staged(measures, "meteodata_unpivoted", sort="datetime")
    dates = generators.dim_dates_between(
        spark, [(incidents, "incident_date"), (measures, "datetime")], cfg.start_not_later, cfg.end_not_earlier)
    hours = generators.dim_hours(spark)

    tables = {
        "dim_agencies": agencies.clean, "dim_weather_stations": dim_stations,
        "dim_dates": dates, "dim_hours": hours,
        "fct_meteodata": facts.build_measure_fact(measures, dates, hours),
        # ids are unique, so the names of each row are counted in place
        "fct_crime_incidents": facts.build_event_fact_from_lists(incidents, "offenses", dates, hours, "incident_date",
                                                                 "incident_time", vocab=vocab),
        "agencies_ir": agencies.quarantine, "full_dupe_oris": agencies.full_dupe_keys,
        "ws_ir": stations.quarantine, "full_dupe_latlongs": stations.full_dupe_keys,
        "ci2": incidents, "ci_offense_names_normalized": names,
        "ci_offense_names_denormalized": pivoted, "meteodata_unpivoted": measures,
    }
    log = reduce(DataFrame.unionByName, [*logs, *inputs.log()])
    if inputs.loads:
        tables["load_errors"] = inputs.errors()

    written = {}
    if write:
        def target(area: str, name: str) -> str:
            written[name] = f"{area}/{name}"
            return _path(cfg, area, name)

        for name, sort_keys in DIMENSION_SORT_KEYS.items():
            # Dimensions are small (they are broadcast): a global sort is cheap.
            sinks.write_table(tables[name].orderBy(*sort_keys), target(cfg.mart, name), cfg.mode)
        # laid out without the counts of names, which are added to the sorted rows
        dated = facts.dated_events(incidents, "offenses", dates, hours, "incident_date", "incident_time")
        sinks.write_fact(dated, target(cfg.mart, "fct_crime_incidents"), "ori", ["ori", "date_id", "hour_id"], cfg.mode,
                         tie_cols=["id"], finish=lambda rows: reshape.count_list_names(rows, "offenses", vocab))
        sinks.write_fact(tables["fct_meteodata"], target(cfg.mart, "fct_meteodata"), "stn",
                         ["stn", "date_id", "hour_id"], cfg.mode)
        for name in ("agencies_ir", "full_dupe_oris", "ws_ir", "full_dupe_latlongs", *(["load_errors"] if inputs.loads else [])):
            table = tables[name].sort("ori") if name == "agencies_ir" else tables[name]
            sinks.write_table(table, target(cfg.stage, name), cfg.mode)
        sinks.append_log(log, target(cfg.stage, "log_table"))
        if cfg.mode == "overwrite":
            _drop_runs(spark, cfg, but=run)
        tables = {n: spark.read.parquet(_path(cfg, cfg.mart, n)) if n.startswith(("dim_", "fct_")) else df
                  for n, df in tables.items()}
    return Star(tables, log, _checks(tables, _read_specs(inputs)[0]), written)


def _checks(t: dict[str, DataFrame], specs: DataFrame) -> dict[str, DataFrame]:
    """Key and length checks of the given tables; they come last, as facts refer to all dimensions."""
    met, inc = t["fct_meteodata"], t["fct_crime_incidents"]
    return {
        "pk_dim_agencies": quality.check_unique(t["dim_agencies"], ["ori"]),
        "pk_dim_weather_stations": quality.check_unique(t["dim_weather_stations"], ["stn_name"]),
        "pk_dim_dates": quality.check_unique(t["dim_dates"], ["id"]),
        "pk_dim_hours": quality.check_unique(t["dim_hours"], ["id"]),
        "pk_fct_crime_incidents": quality.check_unique(inc, ["id"]),
        "fk_incidents_agencies": quality.check_foreign_key(inc, t["dim_agencies"], ["ori"]),
        "fk_incidents_dates": quality.check_foreign_key(inc, t["dim_dates"], ["date_id"], ["id"]),
        "fk_incidents_hours": quality.check_foreign_key(inc, t["dim_hours"], ["hour_id"], ["id"]),
        "fk_meteodata_stations": quality.check_foreign_key(met, t["dim_weather_stations"], ["stn"], ["stn_name"]),
        "fk_meteodata_dates": quality.check_foreign_key(met, t["dim_dates"], ["date_id"], ["id"]),
        "fk_meteodata_hours": quality.check_foreign_key(met, t["dim_hours"], ["hour_id"], ["id"]),
        "len_agencies": quality.check_all_lengths(t["dim_agencies"], AGENCY_LENGTHS, ["ori"]),
        "len_weather_stations": quality.check_all_lengths(t["dim_weather_stations"], STATION_LENGTHS, ["stn_name"]),
        "len_specs": quality.check_all_lengths(specs, SPEC_LENGTHS, ["tbl_name"]),
        "len_incidents": quality.check_all_lengths(inc, INCIDENT_LENGTHS, ["id"]),
    }


def main(argv: list[str] | None = None) -> None:
    """``python -m asterism.plans.star DATA_ROOT OUT_ROOT [--mode overwrite] …``"""
    import argparse

    p = argparse.ArgumentParser(description="Build the star schema from raw files.")
    p.add_argument("data_root")
    p.add_argument("out_root")
    p.add_argument("--mode", default="errorifexists", choices=BUILD_MODES)
    p.add_argument("--start-not-later")
    p.add_argument("--end-not-earlier")
    p.add_argument("--assume-unique-measures", action=argparse.BooleanOptionalAction, default=None)
    p.add_argument("--check-headers", action="store_true")
    p.add_argument("--empty-strings", default="null", choices=["null", "keep"])
    p.add_argument("--scale-mode", default="round", choices=["round", "truncate"])
    p.add_argument("--timestamp-format")
    p.add_argument("--multi-line", action="store_true")
    p.add_argument("--manifest", help="JSON list of the files to load, by their targets")
    p.add_argument("--max-errors", type=int, help="keep up to so many bad rows of a file aside; default: any fails")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("asterism-build-star").getOrCreate()
    cfg = StarConfig(data_root=a.data_root, out_root=a.out_root, mode=a.mode,
                     start_not_later=a.start_not_later, end_not_earlier=a.end_not_earlier,
                     assume_unique_measures=a.assume_unique_measures, check_headers=a.check_headers,
                     empty_strings=a.empty_strings, scale_mode=a.scale_mode,
                     timestamp_format=a.timestamp_format, multi_line=a.multi_line,
                     manifest=a.manifest, max_errors=a.max_errors)
    star = build_star(spark, cfg)
    for name, check in star.checks.items():
        bad = not check.isEmpty()
        print(f"{name}: {'violations found' if bad else 'ok'}")


if __name__ == "__main__":
    main()
