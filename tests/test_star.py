import datetime as dt
import json
import os

import pytest

from asterism.plans.star import StarConfig, build_star
from asterism.sources import sinks
from asterism.sources.load import LoadError
from asterism.sources.store import Store
from tests.conftest import rows

# The header and first stations of the source station file, retyped
# (the last row repeats one station to exercise the dedup).
STATION_ROWS = ["City,Country,Latitude,Longitude",
                "Vancouver,Canada,49.24966,-123.119339",
                "Portland,United States,45.523449,-122.676208",
                "San Francisco,United States,37.774929,-122.419418",
                "Seattle,United States,47.606209,-122.332069",
                "Seattle,United States,47.606209,-122.332069"]
NAMES = ["Vancouver", "Portland", "San_Francisco", "Seattle"]


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _agency(ori, name, lat=40.0):
    return f"{ori},{name},City,State X,SX,Div,Reg,Reg desc,County,true,{lat},-75.0,2001-01-01 00:00:00"


def _incident(orig, ori, date, offenses):
    cols = [str(orig), "2020", ori, "Pub", "Unit", "City", "SX", "State X", "Div", "Reg", "1A", "Cities",
            date, "1", "0", "1", "1", "0", "White", "Not Hispanic", "1", offenses, "1", "Residence",
            "Anti-X", "Individual", "S", "S"]
    return ",".join(cols)


@pytest.fixture()
def data_root(tmp_dir):
    root = f"{tmp_dir}/data"
    _write(f"{root}/agencies.csv", ["hdr"] + [
        _agency("AA0000001", "One"), _agency("AA0000002", "Two"), _agency("AA0000002", "Two"),
        _agency("AA0000003", "Three"), _agency("AA0000003", "Three bis")])
    _write(f"{root}/crime_incidents.csv", ["hdr"] + [
        _incident(1, "AA0000001", "2020-01-02 00:00:00", "Assault;Robbery"),
        _incident(2, "AA0000001", "2020-01-02 00:00:00", "Assault;Robbery"),   # duplicate but for its id
        _incident(3, "AA0000002", "2020-01-05 00:00:00", "Assault;Assault"),
        _incident(4, "AA0000003", "2020-01-06 00:00:00", '"Theft, Other"'),
        _incident(5, "AA0000002", "2020-01-07 00:00:00", ""),                  # NULL list → no fact row
    ])
    _write(f"{root}/meteodata/weather_stations.csv", STATION_ROWS)
    _write(f"{root}/auxfs/station_names.csv", NAMES)
    _write(f"{root}/auxfs/meteoparam_names_fmts.csv",
           ["table_name,data_format", 'temperature,"DECIMAL(5, 2)"', 'pressure,"DECIMAL(6, 2)"',
            'description,"VARCHAR(MAX)"'])
    header = "datetime," + ",".join(NAMES)
    _write(f"{root}/meteodata/temperature.csv", [header, "2020-01-01 00:00:00,1.1,2.2,3.3,4.4",
                                                 "2020-01-01 01:00:00,1.5,,3.5,4.5"])
    _write(f"{root}/meteodata/pressure.csv", [header, "2020-01-01 00:00:00,1000.1,1001,1002,1003",
                                              "2020-01-03 10:00:00,999,999,999,999"])
    _write(f"{root}/meteodata/description.csv", [header, "2020-01-01 00:00:00,sun,rain,fog,snow"])
    return root


def test_build_star(spark, data_root, tmp_dir):
    cfg = StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out", start_not_later="2019-12-30")
    star = build_star(spark, cfg)
    t = star.tables
    assert rows(t["dim_agencies"], "ori", "agency") == [("AA0000001", "One"), ("AA0000002", "Two")]
    assert rows(t["agencies_ir"], "ori", "agency") == [("AA0000003", "Three"), ("AA0000003", "Three bis")]
    assert rows(t["full_dupe_oris"]) == [("AA0000002",)]
    assert rows(t["dim_weather_stations"], "stn_name") == [(n,) for n in sorted(NAMES)]
    stored = spark.read.parquet(f"{tmp_dir}/out/mart/dim_weather_stations").collect()
    assert [(r.stn_country, r.stn_city) for r in stored] == sorted((r.stn_country, r.stn_city) for r in stored)
    d = rows(t["dim_dates"])
    assert d[0] == (1, dt.date(2019, 12, 30)) and d[-1][1] == dt.date(2020, 1, 7)
    assert t["dim_hours"].count() == 24

    m = t["fct_meteodata"]
    assert m.columns == ["date_id", "hour_id", "datetime", "stn", "description", "pressure", "temperature"]
    assert m.count() == 3 * 4  # three distinct hours × four stations, full-joined
    assert rows(m.where("stn = 'Portland' AND hour_id = 1"), "temperature") == [(None,)]

    e = t["fct_crime_incidents"]
    assert {"date_id", "hour_id", "id", "ori", "incident_time", "offenses", "name_cnt", "assault", "robbery",
            "theft, other"} <= set(e.columns)
    assert rows(e, "ori", "assault", "robbery") == [("AA0000001", 1, 1), ("AA0000002", 2, 0), ("AA0000003", 0, 0)]
    assert rows(e, "hour_id") == [(None,)] * 3  # no time of day in the source
    msgs = [r.message for r in star.log.collect()]
    assert any("inconsistent" in m for m in msgs) and any("groups of crime_incidents" in m for m in msgs)
    assert spark.read.parquet(f"{tmp_dir}/out/stage/log_table").count() == len(msgs)

    # the incident of the quarantined agency is an orphan of dim_agencies
    assert rows(star.checks["fk_incidents_agencies"]) == [("AA0000003", 1)]
    assert star.checks["fk_meteodata_stations"].count() == 0
    assert star.checks["pk_fct_crime_incidents"].count() == 0


def test_build_star_rerun_refuses_then_overwrites(spark, data_root, tmp_dir):
    cfg = StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out")
    build_star(spark, cfg)
    with pytest.raises(Exception):
        build_star(spark, cfg)
    cfg.mode = "overwrite"
    build_star(spark, cfg)


def test_build_star_checks_station_columns(spark, data_root, tmp_dir):
    header = "datetime," + ",".join(NAMES[:3])
    _write(f"{data_root}/meteodata/pressure.csv", [header, "2020-01-01 00:00:00,1,2,3"])
    with pytest.raises(ValueError, match="station columns"):
        build_star(spark, StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out"), write=False)


def test_build_star_header_names_on_request(spark, data_root, tmp_dir):
    header = "datetime," + ",".join(reversed(NAMES))
    _write(f"{data_root}/meteodata/pressure.csv", [header, "2020-01-01 00:00:00,1,2,3,4"])
    build_star(spark, StarConfig(data_root=data_root, out_root=f"{tmp_dir}/o1"), write=False)
    with pytest.raises(ValueError, match="differ from the spec"):
        build_star(spark, StarConfig(data_root=data_root, out_root=f"{tmp_dir}/o2", check_headers=True),
                   write=False)


def test_command_line(spark, data_root, tmp_dir, capsys):
    from asterism.plans.star import main

    main([data_root, f"{tmp_dir}/cli", "--start-not-later", "2019-12-30"])
    out = capsys.readouterr().out
    assert "fk_incidents_agencies: violations found" in out and "pk_dim_agencies: ok" in out
    assert spark.read.parquet(f"{tmp_dir}/cli/mart/fct_meteodata").count() == 12


def test_measures_repeated_datetime_uses_exact_chain(spark, data_root, tmp_dir):
    from asterism.plans.star import load_measures

    cfg = StarConfig(data_root=data_root, out_root=f"{tmp_dir}/x")
    unique, _ = load_measures(spark, cfg)
    assert unique.count() == 12
    header = "datetime," + ",".join(NAMES)
    _write(f"{data_root}/meteodata/pressure.csv", [header, "2020-01-01 00:00:00,1,2,3,4",
                                                   "2020-01-01 00:00:00,5,6,7,8"])
    repeated, _ = load_measures(spark, cfg)
    # the repeated hour doubles 00:00 for every station (as the join does), and
    # 01:00 (temperature only) stays: 4 × 2 + 4 rows
    assert repeated.count() == 4 * 2 + 4
    assert rows(repeated.where("stn = 'Seattle' AND datetime = '2020-01-01 00:00:00'"), "pressure") == [
        (4,), (8,)]


def test_rebuild_with_changed_input(spark, data_root, tmp_dir):
    """Neither mode reads what an earlier run has stored."""
    cfg = StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out")
    first = {n: rows(t) for n, t in build_star(spark, cfg).tables.items() if n.startswith(("dim_", "fct_"))}
    _write(f"{data_root}/agencies.csv", ["hdr", _agency("AA0000001", "Other name"), _agency("AA0000009", "Nine")])
    with pytest.raises(Exception):
        build_star(spark, cfg)
    stored = spark.read.parquet(f"{tmp_dir}/out/mart/dim_agencies")
    assert rows(stored) == first["dim_agencies"]  # refused: nothing has changed
    cfg.mode = "overwrite"
    again = build_star(spark, cfg).tables
    assert rows(again["dim_agencies"], "ori", "agency") == [("AA0000001", "Other name"), ("AA0000009", "Nine")]
    assert all(rows(again[n]) == first[n] for n in first if n != "dim_agencies") and rows(again["agencies_ir"]) == []
    for mode in ("append", "ignore"):
        with pytest.raises(ValueError, match="mode"):
            StarConfig(data_root=data_root, out_root=tmp_dir, mode=mode)


def test_checks_read_the_written_tables(spark, data_root, tmp_dir):
    from tests.conftest import plan

    star = build_star(spark, StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out"))
    for name, check in star.checks.items():
        scans = [line for line in plan(check).splitlines() if "FileScan" in line]
        assert scans and all("/out/mart/" in s or name == "len_specs" for s in scans), name


def test_event_audit_and_measures_read_stored_tables(spark, data_root, tmp_dir):
    from tests.conftest import plan

    star = build_star(spark, StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out"))
    for frame in (star.log, star.tables["meteodata_unpivoted"], star.tables["ci2"]):
        assert "FileScan csv" not in plan(frame)


def test_build_from_a_manifest_with_bad_rows_kept_aside(spark, data_root, tmp_dir):
    names = ["agencies.csv", "crime_incidents.csv", "meteodata/weather_stations.csv", "auxfs/station_names.csv",
             "auxfs/meteoparam_names_fmts.csv", "meteodata/temperature.csv", "meteodata/pressure.csv", "meteodata/description.csv"]
    os.rename(f"{data_root}/agencies.csv", f"{data_root}/agencies-2020.csv")
    with open(f"{data_root}/crime_incidents.csv", "a") as f:
        f.write(_incident(6, "AA0000001", "no date", "Robbery") + "\n")
    pairs = [{"local": "agencies-2020.csv" if n == "agencies.csv" else n, "s3": n} for n in names]
    _write(f"{tmp_dir}/files.json", [json.dumps({"data_files": pairs})])
    cfg = dict(data_root=data_root, out_root=f"{tmp_dir}/out", manifest=f"{tmp_dir}/files.json", mode="overwrite")
    with pytest.raises(LoadError, match="1 of 6 records are bad"):
        build_star(spark, StarConfig(**cfg, max_errors=0))
    star = build_star(spark, StarConfig(**cfg, max_errors=1))
    assert rows(star.tables["fct_crime_incidents"], "ori") == [("AA0000001",), ("AA0000002",), ("AA0000003",)]
    assert rows(spark.read.parquet(f"{tmp_dir}/out/stage/load_errors"), "input", "line", "column", "reason", "value") == [
        ("crime_incidents.csv", 7, "incident_date", "not a timestamp_ntz", "no date")]
    log = [r[0] for r in spark.read.parquet(f"{tmp_dir}/out/stage/log_table").select("message").collect()]
    assert [m for m in log if m.startswith("5 rows loaded, 1 rejected") and m.endswith("crime_incidents.csv")]
    assert [m for m in log if m.startswith("5 rows loaded, 0 rejected") and m.endswith("agencies-2020.csv")]
    os.remove(f"{data_root}/meteodata/pressure.csv")
    with pytest.raises(ValueError, match="not found: meteodata/pressure.csv"):
        build_star(spark, StarConfig(**cfg))


def test_a_versioned_build_is_seen_whole_or_not_at_all(spark, data_root, tmp_dir, monkeypatch):
    cfg = StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out", mode="versioned")
    build_star(spark, cfg)
    store = Store(spark, f"{tmp_dir}/out")
    first = rows(store.read("fct_crime_incidents"))
    assert first and set(store.tables()) >= {"dim_agencies", "dim_dates", "fct_meteodata", "agencies_ir", "log_table"}
    _write(f"{data_root}/crime_incidents.csv", ["hdr", _incident(9, "AA0000001", "2020-02-02 00:00:00", "Arson")])
    real = sinks.write_fact

    def killed(df, target, *rest, **options):
        if "fct_meteodata" in target:
            raise KeyboardInterrupt
        real(df, target, *rest, **options)

    monkeypatch.setattr(sinks, "write_fact", killed)
    with pytest.raises(KeyboardInterrupt):
        build_star(spark, cfg)
    assert rows(store.read("fct_crime_incidents")) == first and store.commits() == [1]
    monkeypatch.setattr(sinks, "write_fact", real)
    star = build_star(spark, cfg)
    assert rows(store.read("fct_crime_incidents"), "offenses") == [("Arson",)] and star.checks["pk_dim_dates"].isEmpty()
    assert rows(store.read("fct_crime_incidents", 1)) == first
    assert store.read("log_table").count() == 2 * store.read("log_table", 1).count()


def test_overwriting_removes_what_earlier_builds_stored_on_their_way(spark, data_root, tmp_dir):
    for mode in ("errorifexists", "overwrite", "overwrite"):
        build_star(spark, StarConfig(data_root=data_root, out_root=f"{tmp_dir}/out", mode=mode))
        assert len([n for n in os.listdir(f"{tmp_dir}/out/stage") if n.startswith("run-")]) == 1
