"""The registered queries: each operator of the library bound to the driver's tables.

Analogues used (the reference's own inputs are not part of the test data):

* ``lineitem`` keyed by (order, line) is a dimension with repeats and conflicts;
  ``documents`` keyed by the whole text is a second one.
* Each line carries its own delimited name list (the incident's offense list),
  built from the line's values, so no list is ever gathered from many rows. The
  lines then go through the event clean step (dedup, ids) like the incidents.
* Aggregates per day and nation of orders and lines, and per hour and type of
  ``events``, are the station readings.

Every query reads whole tables; nothing is sampled, capped or subset by id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from asterism.functions.columns import hour_start
from asterism.functions.types import spark_type
from asterism.operators import events as ev
from asterism.operators import facts, generators, quality, reshape, schema
from asterism.operators import keys as key_checks
from asterism.plans import star
from asterism.session import scratch_path
from asterism.sources import csv as csv_src
from asterism.sources import load, sinks
from asterism.sources.store import Store

LI_KEYS = ["l_orderkey", "l_linenumber"]
DEDUP_COLS = ["l_partkey", "l_suppkey", "l_returnflag"]
MEASURE_KEYS = ["datetime", "stn"]
# Declared lengths checked on part.
PART_LENGTHS = {"p_name": 10, "p_brand": 7, "p_type": 6}
# Fixed value: the user bound that widens the order date dimension.
DATES_START_NOT_LATER = "1994-12-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- dimensions with repeats: lineitem (order, line) and documents (text) -------------

def _li(spark, d):
    return table(spark, d, "lineitem").select(*LI_KEYS, "l_returnflag", "l_linestatus")


def _conform_li(spark, d):
    # the distinct rows are stored once: every output reads them and not the raw table
    return quality.conform_dimension(_li(spark, d), LI_KEYS, copies_path=scratch_path(spark, "conform"))


def _conform_docs(spark, d):
    return quality.conform_dimension(table(spark, d, "documents").select("text", "lang", "source"), ["text"],
                                     copies_path=scratch_path(spark, "conform-docs"), digest_key=True)


def conform_clean(spark, d):
    return _conform_li(spark, d).clean


def conform_quarantine(spark, d):
    return _conform_li(spark, d).quarantine


def conform_full_dupes(spark, d):
    return _conform_li(spark, d).full_dupe_keys


def conform_audit(spark, d):
    return _conform_li(spark, d).audit.select("n_rows", "full_dupe_groups", "conflicting_keys")


def audit_log(spark, d):
    return quality.audit_rows(_conform_li(spark, d).audit, "stage", "lineitem").drop("dt")


def conform_clean_docs(spark, d):
    return _conform_docs(spark, d).clean


def conform_quarantine_docs(spark, d):
    return _conform_docs(spark, d).quarantine


def key_surplus(spark, d):
    return quality.key_surplus(table(spark, d, "documents"), "text")


def pk_violations(spark, d):
    return quality.check_unique(table(spark, d, "lineitem"), LI_KEYS)


def pk_violations_sorted(spark, d):
    """Parts and suppliers of lines that repeat, from files that hold the lines in that order."""
    path, keys = scratch_path(spark, "sorted"), ["l_partkey", "l_suppkey"]
    sinks.write_fact(table(spark, d, "lineitem").select(*keys, "l_quantity"), path, keys[0], keys)
    return key_checks.check_unique_sorted(spark.read.parquet(path), keys)


def fk_orphans(spark, d):
    # labels cover some of the documents: the others are orphans
    return quality.check_foreign_key(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


def fk_orphans_dense(spark, d):
    """Lines whose order is pending, as if such orders were missing: whole numbers, by maps of the keys."""
    known = table(spark, d, "orders").where("o_orderstatus <> 'P'")
    return key_checks.check_dense_foreign_key(table(spark, d, "lineitem"), known, "l_orderkey", "o_orderkey")


def length_violations(spark, d):
    return quality.check_lengths(table(spark, d, "part"), "p_name", 10, ["p_partkey"])


def length_violations_all(spark, d):
    # V4 over several declared lengths in one pass (long form: key, column, len).
    return quality.check_all_lengths(table(spark, d, "part"), PART_LENGTHS, ["p_partkey"])


def conflicting_keys(spark, d):
    return quality.conflicting_keys(_li(spark, d), LI_KEYS)


def slug_key(spark, d):
    return quality.add_slug_key(table(spark, d, "part"), "p_name", "slug")


# --- event table cleaning ---------------------------------------------------------------

def _deduped(spark, d):
    return ev.dedup_with_count(table(spark, d, "lineitem"), DEDUP_COLS)


def surrogate_ids(spark, d):
    return ev.with_surrogate_id(_deduped(spark, d), "id", DEDUP_COLS)


def dedup_audit(spark, d):
    return ev.dedup_audit(_deduped(spark, d))


def dedup_log(spark, d):
    return quality.audit_rows(ev.dedup_audit(_deduped(spark, d)), "stage", "lineitem").drop("dt")


def clean_events(spark, d):
    clean, _ = ev.clean_events(table(spark, d, "lineitem"), DEDUP_COLS + ["l_shipdate"],
                               date_col="l_shipdate")
    return clean


# --- compound name lists: split, vocabulary, pivot ---------------------------------------

def _line_list():
    """A delimited list of names, built from a line's values.

    NULL when the quantity is over 48, empty when it is under 2; otherwise the
    return flag (twice when the discount is at least 5%), the line status, and
    an empty last name when the tax is zero.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    listed = F.concat(flag, F.when(F.col("l_discount") >= 0.05, F.concat(F.lit(";"), flag)).otherwise(F.lit("")),
                      F.lit(";"), status, F.when(F.col("l_tax") == 0, F.lit(";")).otherwise(F.lit("")))
    return (F.when(F.col("l_quantity") > 48, F.lit(None).cast("string"))
            .when(F.col("l_quantity") < 2, F.lit("")).otherwise(listed))


def compound(spark, d):
    """Each line with its own list of names."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", F.to_date("l_shipdate").alias("day"), _line_list().alias("offenses"))


INCIDENT_COLS = ["l_orderkey", "day", "offenses"]


def incidents(spark, d):
    """L3 on the lines: dedup on the kept columns, ids 1…n, NULL time of day."""
    clean, _ = ev.clean_events(compound(spark, d), INCIDENT_COLS, date_col="day")
    return clean


def split_rows(spark, d):
    return reshape.split_to_rows(incidents(spark, d), ["id"], "offenses")


def vocabulary(spark, d):
    return reshape.vocabulary_frame(split_rows(spark, d), "offense_name")


def pivot_counts(spark, d):
    return reshape.pivot_counts(split_rows(spark, d), ["id", "name_cnt"])


def pivot_flags(spark, d):
    return reshape.pivot_counts(split_rows(spark, d), ["id", "name_cnt"], flags=True)


def pivot_lists(spark, d):
    return reshape.count_list_names(incidents(spark, d), "offenses", keep_cols=["id"])


# --- measures: wide, long, combined -------------------------------------------------------

def _events(spark, d):
    return table(spark, d, "events")


def _nation_of(df, spark, d, party, key, party_key, nation_key):
    """``df`` with the nation's name (``stn``) of its customer or supplier."""
    nation = table(spark, d, "nation")
    return (df.join(table(spark, d, party), F.col(key) == F.col(party_key))
            .join(nation, F.col(nation_key) == F.col("n_nationkey")).withColumnRenamed("n_name", "stn"))


def _measures(spark, d):
    """Three measures whose keys differ by nature: orders by day and customer nation, lines by
    day and supplier nation, events by hour and type."""
    orders = _nation_of(table(spark, d, "orders"), spark, d, "customer", "o_custkey", "c_custkey", "c_nationkey")
    lines = _nation_of(table(spark, d, "lineitem"), spark, d, "supplier", "l_suppkey", "s_suppkey", "s_nationkey")
    by = lambda df, ts, stn: df.groupBy(hour_start(F.col(ts)).alias("datetime"), F.col(stn).alias("stn"))
    return {
        "big": by(orders, "o_orderdate", "stn").agg(F.count("o_orderkey").alias("big")),
        "hi": by(lines, "l_shipdate", "stn").agg(F.max("l_extendedprice").alias("hi")),
        "lo": by(_events(spark, d), "ts", "event_type").agg(F.min("value").alias("lo")),
    }


def _wide(spark, d):
    e = _events(spark, d)
    stations = reshape.vocabulary(e, "event_type")
    return (e.groupBy(hour_start(F.col("ts")).alias("datetime"))
            .pivot("event_type", stations).agg(F.max("value"))), stations


def unpivot_measures(spark, d):
    wide, stations = _wide(spark, d)
    return reshape.unpivot_measures(wide, ["datetime"], stations, "stn", "v")


def _stored(spark, df, name):
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def full_join(spark, d):
    # stored as in the whole build, since their keys are counted before they are joined
    stored = {name: _stored(spark, df, f"measure-{name}") for name, df in _measures(spark, d).items()}
    return reshape.full_join_measures(stored, MEASURE_KEYS)


def full_join_repeated(spark, d):
    """Orders, lines and events by part of a day: keys that repeat within each input, some of them NULL."""
    day = lambda ts: F.to_date(F.col(ts))
    orders = table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, day("o_orderdate")).alias("day"), (F.col("o_custkey") % 25).alias("k"), "o_orderkey")
    lines = table(spark, d, "lineitem").where("l_linenumber = 1").select(
        day("l_shipdate").alias("day"), F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey") % 25).alias("k"), "l_extendedprice")
    parts = table(spark, d, "part").select(
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 900).cast("int")).alias("day"),
        (F.col("p_partkey") % 25).alias("k"), "p_retailprice")
    return reshape.full_join_measures([orders, lines, parts], ["day", "k"])


def union_measures(spark, d):
    return reshape.full_join_measures(_measures(spark, d), MEASURE_KEYS, assume_unique=True)


# --- dimensions and facts -----------------------------------------------------------------

def _order_date_sources(spark, d):
    return [(table(spark, d, "orders"), "o_orderdate"), (table(spark, d, "lineitem"), "l_shipdate")]


def date_bounds(spark, d):
    return generators.date_bounds(_order_date_sources(spark, d), DATES_START_NOT_LATER, None)


def dim_dates(spark, d):
    return generators.dim_dates_between(spark, _order_date_sources(spark, d), DATES_START_NOT_LATER, None)


def _measure_dates(spark, d):
    return generators.dim_dates_between(spark, [*_order_date_sources(spark, d), (_events(spark, d), "ts")])


def dim_hours(spark, d):
    # Hour-of-day histogram (at most 24 rows by construction) on the hour dimension.
    per_hour = (_events(spark, d).groupBy(F.hour("ts").cast("int").alias("id"))
                .agg(F.count("event_id").alias("n_events")))
    return (generators.dim_hours(spark).join(F.broadcast(per_hour), "id", "left")
            .select("id", "hour", F.coalesce("n_events", F.lit(0)).alias("n_events")))


def fct_measures(spark, d):
    measures = reshape.full_join_measures(_measures(spark, d), MEASURE_KEYS, assume_unique=True)
    return facts.build_measure_fact(measures, _measure_dates(spark, d), generators.dim_hours(spark))


def fct_events(spark, d):
    return facts.build_event_fact_from_lists(incidents(spark, d), "offenses", dim_dates(spark, d),
                                             generators.dim_hours(spark), "day", "incident_time")


def fct_events_joined(spark, d):
    events = incidents(spark, d)
    names = reshape.pivot_counts(reshape.split_to_rows(events, ["id"], "offenses"), ["id", "name_cnt"])
    return facts.build_event_fact(events, names, dim_dates(spark, d), generators.dim_hours(spark),
                                  ["id"], "day", "incident_time")


def fct_readback(spark, d):
    path = scratch_path(spark, "fct_measures")
    sinks.write_fact(fct_measures(spark, d), path, "stn", ["stn", "date_id", "hour_id"])
    return spark.read.parquet(path)


def fct_range(spark, d):
    """Some weeks of the measure fact of a range of stations, from the files that its index names."""
    path = scratch_path(spark, "fct_indexed")
    sinks.write_fact(fct_measures(spark, d), path, "stn", ["stn", "date_id", "hour_id"], index=True)
    return sinks.read_range(spark, path, {"stn": ("NATION_10", "NATION_17"), "date_id": (100, 400)})


def bucketed_join(spark, d):
    """Lines with their orders, both stored in buckets of the order's key: joined where they lie."""
    run = uuid.uuid4().hex
    for name, key, columns in (("orders", "o_orderkey", ["o_orderkey", "o_orderdate"]),
                               ("lineitem", "l_orderkey", ["l_orderkey", "l_linenumber", "l_shipdate"])):
        sinks.write_fact(table(spark, d, name).select(*columns), f"{name}_{run}", key, columns, layout="bucket", buckets=16,
                         table_path=scratch_path(spark, f"bucketed-{name}"))
    lines, orders = spark.table(f"lineitem_{run}"), spark.table(f"orders_{run}")
    days = F.date_diff("l_shipdate", "o_orderdate")
    return (lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max(days).alias("longest")))


def star_daily(spark, d):
    fact = fct_measures(spark, d)
    dates = _measure_dates(spark, d).withColumnRenamed("id", "date_id")
    return (fact.join(dates, "date_id").groupBy("date")
            .agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"),
                 F.sum("big").cast("long").alias("big"), F.count(F.lit(1)).alias("n_rows")))


# --- specs: schema text, ordered names, positional CSV ------------------------------------

def _specs(spark, d):
    nation = table(spark, d, "nation")
    stations = (table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("station_name")).distinct())
    params = (table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("r_name").alias("tbl_name"),
                      F.concat(F.lit("DECIMAL(6, "), F.col("r_regionkey").cast("string"), F.lit(")")).alias("col_fmt"))
              .distinct())
    return params, stations


def schema_ddl(spark, d):
    return schema.schema_ddl_frame(*_specs(spark, d))


def schema_types(spark, d):
    """The structs that the wide files are read with, as text."""
    structs = schema.measure_schemas(*_specs(spark, d))
    return spark.createDataFrame([(name, s.simpleString()) for name, s in structs.items()], "tbl_name string, struct string")


def param_order(spark, d):
    return reshape.number_names(table(spark, d, "part"), "p_brand")


def csv_scan(spark, d):
    path = scratch_path(spark, "part_csv")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("title"),
                                          F.col("p_retailprice").alias("cost"))
    part.write.option("header", True).csv(path)
    return csv_src.read_positional_csv(spark, path, "id BIGINT, name STRING, price DOUBLE")


def csv_texts(spark, d):
    """All documents written as CSV and read back: quotes, commas, line breaks, backslashes, and
    columns of each type that the loads use."""
    path = scratch_path(spark, "documents_csv")
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("a"), F.col("text").alias("b"), F.concat(F.lit('"'), "source", F.lit('\\\\",')).alias("c"),
        (F.col("n_chars") / 8).cast("decimal(12,3)").alias("d"), (F.col("n_chars") % 2 == 0).alias("e"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)").alias("f"))
    csv_src.write_csv(docs, path)
    return csv_src.read_positional_csv(
        spark, path, "doc_id BIGINT, text STRING, quoted STRING, eighth DECIMAL(12,3), even BOOLEAN, written TIMESTAMP_NTZ",
        multi_line=True, empty_strings="keep")


def csv_times(spark, d):
    """All events' times written month first, by the second from a night on that the clocks change, and read back."""
    path = scratch_path(spark, "times_csv")
    at = F.expr("timestamp_ntz'2021-03-14 00:00:00' + make_dt_interval(0, 0, 0, event_id % 43200)")
    table(spark, d, "events").select("event_id", F.date_format(at, "M/d/yyyy H:mm:ss").alias("t")).write.csv(path)
    return csv_src.read_positional_csv(spark, path, "event_id BIGINT, at TIMESTAMP_NTZ", header=False)


def _planted_load(spark, d):
    """All documents as CSV, where by its length a row has a number that is none, no source, or a field too few."""
    path = scratch_path(spark, "planted_csv")
    field = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    kind = F.col("n_chars") % 20
    number = F.when(kind == 3, F.concat(F.lit("x"), F.col("n_chars").cast("string"))).otherwise(F.col("n_chars").cast("string"))
    source = F.when(kind == 7, F.lit("")).otherwise(F.col("source"))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), field(F.col("text")), number, F.when(kind != 11, source))
    table(spark, d, "documents").select(line).write.text(path)
    fields = "doc_id BIGINT, text STRING, n_chars INT, source VARCHAR(100) NOT NULL"
    return load.load_csv(spark, path, fields, max_errors=1 << 60, header=False, empty_strings="keep")


def load_rows(spark, d):
    """The good rows of a load that keeps bad ones aside."""
    return _planted_load(spark, d).rows


def load_errors(spark, d):
    """What is wrong with the bad rows of that load."""
    number = F.regexp_extract("record", "^([0-9]+),", 1).cast("long")
    return _planted_load(spark, d).errors.select(number.alias("doc_id"), "column", "reason", "value")


def files_loaded(spark, d):
    """Customers and suppliers from the files that a manifest names: rows by target, counted by the file they came from."""
    root = scratch_path(spark, "manifest")
    pairs = [("c/customer.csv", "customer"), ("s/supplier.csv", "supplier")]
    csv_src.write_csv(table(spark, d, "customer").select("c_custkey", "c_name"), f"{root}/{pairs[0][0]}")
    csv_src.write_csv(table(spark, d, "supplier").select("s_suppkey", "s_name"), f"{root}/{pairs[1][0]}")
    listed = F.array(*[F.struct(F.lit(a).alias("local"), F.lit(b).alias("s3")) for a, b in pairs])
    spark.range(1).select(listed.alias("data_files")).write.json(f"{root}/manifest")
    paths = load.manifest_paths(spark, csv_src.read_manifest(spark, f"{root}/manifest"), root, [b for _, b in pairs])
    counts = [load.load_csv(spark, path, "id BIGINT, name STRING").by_file().select(F.lit(name).alias("target"), "n_rows", "n_bad")
              for name, path in sorted(paths.items())]
    return counts[0].unionByName(counts[1]).groupBy("target").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))


def name_counts(spark, d):
    return reshape.count_names(split_rows(spark, d), ["id", "name_cnt"])


def fct_events_timed(spark, d):
    """The event fact with a time of day: events reported on the hour, so hours match."""
    reports = _events(spark, d).select(F.col("event_type").alias("offenses"), hour_start(F.col("ts")).alias("day"))
    clean, _ = ev.clean_events(reports, ["offenses", "day"], date_col="day", time_source="day")
    return facts.build_event_fact_from_lists(clean, "offenses", _measure_dates(spark, d), generators.dim_hours(spark),
                                             "day", "incident_time")


def log_appended(spark, d):
    """Audit rows appended to a log table by two runs, and read back."""
    path = scratch_path(spark, "log")
    for _ in range(2):
        sinks.append_log(quality.audit_rows(ev.dedup_audit(_deduped(spark, d)), "stage", "lineitem"), path)
    return spark.read.parquet(path).drop("dt")


def table_replaced(spark, d):
    """A table that refuses a second write, is then replaced, and read back."""
    path = scratch_path(spark, "replaced")
    sinks.write_table(table(spark, d, "supplier"), path)
    try:
        sinks.write_table(table(spark, d, "orders"), path)
    except AnalysisException:
        sinks.write_table(table(spark, d, "orders"), path, "overwrite")
    return spark.read.parquet(path)


def table_rewritten(spark, d):
    """A stored table replaced by a result that reads it: customers with what their nation's largest balance has more."""
    store = Store(spark, scratch_path(spark, "store"))
    with store.change() as change:
        change.replace("customer", table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    with store.change() as change:
        rows = store.read("customer")
        largest = rows.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("largest"))
        change.replace("customer", rows.join(largest, "c_nationkey").select(
            "c_custkey", (F.col("largest") - F.col("c_acctbal")).alias("behind")))
    return store.read("customer")


def _loads(spark, d):
    """Compound lists by the ship dates of two loads, the second one holding rows of the first."""
    rows = compound(spark, d)
    return [rows.where("day < '1996-01-01'"), rows.where("day >= '1995-01-01'")]


def rows_inserted(spark, d):
    """A table loaded in two overlapping parts: the second adds only rows that are new, with ids that run on."""
    store = Store(spark, scratch_path(spark, "store"))
    first, second = _loads(spark, d)
    with store.change() as change:
        columns = first.columns
        change.replace("incidents", ev.with_surrogate_id(first.distinct(), "id", columns))
    with store.change() as change:
        change.insert_new("incidents", second, "id")
    return store.read("incidents")


# --- the whole build, from raw files ------------------------------------------------------

# The types of the measures that are written as wide files.
WIDE_MEASURES = {"big": "BIGINT", "hi": "DECIMAL(12, 2)"}


def _raw(df, fields, **columns):
    """``df`` as the columns of a raw file, in order; those not given are empty."""
    return df.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in StructType.fromDDL(fields).fields])


def _raw_measures(spark, d, root):
    """The specs and wide measure files: orders and lines by day and nation, a column a nation."""
    nation = table(spark, d, "nation").orderBy("n_nationkey").select("n_name")
    # one file, as its lines are numbered; a row a nation
    nation.coalesce(1).write.options(**csv_src.DIALECT).csv(f"{root}/auxfs/station_names.csv")
    csv_src.write_csv(spark.createDataFrame(list(WIDE_MEASURES.items()), star.SPECS_SCHEMA),
                      f"{root}/auxfs/meteoparam_names_fmts.csv")
    names = [r[0] for r in nation.collect()]  # they become columns
    measures = _measures(spark, d)
    for name, kind in WIDE_MEASURES.items():
        wide = measures[name].groupBy("datetime").pivot("stn", names).agg(F.max(name).cast(spark_type(kind)))
        csv_src.write_csv(wide, f"{root}/meteodata/{name}.csv")


def _raw_rows(spark, d, root):
    """The other raw files: suppliers are the agencies, nations the weather stations, lines the incidents."""
    ori = lambda key: F.format_string("S%08d", F.col(key))
    csv_src.write_csv(_raw(table(spark, d, "supplier"), star.AGENCIES_SCHEMA, ori=ori("s_suppkey"), agency=F.col("s_name"),
                           nibrs=F.col("s_acctbal") > 0, ori_lat=F.col("s_acctbal")), f"{root}/agencies.csv")
    csv_src.write_csv(_raw(table(spark, d, "nation"), star.STATIONS_SCHEMA, stn_city=F.col("n_name"),
                           stn_lat=F.col("n_nationkey"), stn_long=F.col("n_regionkey")),
                      f"{root}/meteodata/weather_stations.csv")
    csv_src.write_csv(_raw(table(spark, d, "lineitem"), star.INCIDENTS_SCHEMA, incident_id_orig=F.col("l_orderkey"),
                           ori=ori("l_suppkey"), incident_date=F.col("l_shipdate"), adult_victim_count=F.col("l_quantity"),
                           offenses=_line_list(), location_name=F.col("l_linestatus")), f"{root}/crime_incidents.csv")


def _star_config(spark):
    return star.StarConfig(scratch_path(spark, "raw"), scratch_path(spark, "star"), check_headers=True, empty_strings="keep",
                           start_not_later=DATES_START_NOT_LATER)


def star_measures(spark, d):
    """Specs, schemas, wide files, long tables, their combination and the stored measure fact."""
    cfg = _star_config(spark)
    _raw_measures(spark, d, cfg.data_root)

    def staged(df, name):
        sinks.write_table(df, f"{cfg.out_root}/{name}")
        return spark.read.parquet(f"{cfg.out_root}/{name}")

    measures = staged(star.load_measures(spark, cfg, staged)[0], "measures")
    dates = generators.dim_dates_between(spark, [(measures, "datetime")], cfg.start_not_later)
    sinks.write_fact(facts.build_measure_fact(measures, dates, generators.dim_hours(spark)), f"{cfg.out_root}/fact",
                     "stn", ["stn", "date_id", "hour_id"])
    return spark.read.parquet(f"{cfg.out_root}/fact")


def star_incidents(spark, d):
    """The event fact (its columns that hold data) of the whole build from raw files."""
    cfg = _star_config(spark)
    _raw_measures(spark, d, cfg.data_root)
    _raw_rows(spark, d, cfg.data_root)
    return star.build_star(spark, cfg).tables["fct_crime_incidents"].select(
        "date_id", "id", "ori", "incident_date", "adult_victim_count", "offenses", "location_name", "name_cnt",
        "not_named", "a", "f", "n", "o", "r")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_clean": conform_clean,
    "conform_quarantine": conform_quarantine,
    "conform_full_dupes": conform_full_dupes,
    "conform_audit": conform_audit,
    "audit_log": audit_log,
    "conform_clean_docs": conform_clean_docs,
    "conform_quarantine_docs": conform_quarantine_docs,
    "key_surplus": key_surplus,
    "pk_violations": pk_violations,
    "pk_violations_sorted": pk_violations_sorted,
    "fk_orphans": fk_orphans,
    "fk_orphans_dense": fk_orphans_dense,
    "length_violations": length_violations,
    "length_violations_all": length_violations_all,
    "conflicting_keys": conflicting_keys,
    "dedup_log": dedup_log,
    "slug_key": slug_key,
    "surrogate_ids": surrogate_ids,
    "dedup_audit": dedup_audit,
    "clean_events": clean_events,
    "compound": compound,
    "incidents": incidents,
    "split_rows": split_rows,
    "vocabulary": vocabulary,
    "pivot_counts": pivot_counts,
    "pivot_flags": pivot_flags,
    "unpivot_measures": unpivot_measures,
    "full_join": full_join,
    "full_join_repeated": full_join_repeated,
    "union_measures": union_measures,
    "date_bounds": date_bounds,
    "dim_dates": dim_dates,
    "dim_hours": dim_hours,
    "fct_measures": fct_measures,
    "fct_events": fct_events,
    "fct_events_joined": fct_events_joined,
    "pivot_lists": pivot_lists,
    "fct_readback": fct_readback,
    "fct_range": fct_range,
    "bucketed_join": bucketed_join,
    "star_daily": star_daily,
    "schema_ddl": schema_ddl,
    "param_order": param_order,
    "csv_scan": csv_scan,
    "csv_texts": csv_texts,
    "csv_times": csv_times,
    "load_rows": load_rows,
    "load_errors": load_errors,
    "files_loaded": files_loaded,
    "name_counts": name_counts,
    "fct_events_timed": fct_events_timed,
    "schema_types": schema_types,
    "log_appended": log_appended,
    "table_replaced": table_replaced,
    "table_rewritten": table_rewritten,
    "rows_inserted": rows_inserted,
    "star_measures": star_measures,
    "star_incidents": star_incidents,
}
