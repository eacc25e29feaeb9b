"""Oracle SQL (DuckDB dialect) for every registered query in :mod:`asterism.plans.bindings`.

Shared fragments go into a leading WITH list, with the fragments they name.
"""

from __future__ import annotations

_HOUR = "date_trunc('hour', ts)"

FRAGMENTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "li": ("SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem", ()),
    "ir": ("SELECT l_orderkey, l_linenumber FROM (SELECT DISTINCT * FROM li) GROUP BY ALL HAVING count(*) > 1",
           ("li",)),
    "docs": ("SELECT text, lang, source FROM documents", ()),
    "docs_ir": ("SELECT text FROM (SELECT DISTINCT * FROM docs) GROUP BY text HAVING count(*) > 1", ("docs",)),
    "compound": ("SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, "
                 "CASE WHEN l_quantity > 48 THEN NULL WHEN l_quantity < 2 THEN '' "
                 "ELSE l_returnflag || CASE WHEN l_discount >= 0.05 THEN ';' || l_returnflag ELSE '' END "
                 "|| ';' || l_linestatus || CASE WHEN l_tax = 0 THEN ';' ELSE '' END END AS offenses "
                 "FROM lineitem", ()),
    "incidents": ("SELECT CAST(row_number() OVER (ORDER BY l_orderkey, day, offenses NULLS FIRST) AS BIGINT) "
                  "AS id, l_orderkey, day, CAST(NULL AS VARCHAR) AS incident_time, offenses "
                  "FROM compound GROUP BY l_orderkey, day, offenses", ("compound",)),
    "names": ("SELECT id, CAST(name_cnt AS BIGINT) AS name_cnt, CAST(num AS BIGINT) AS num, offense_name "
              "FROM (SELECT id, len(parts) AS name_cnt, generate_subscripts(parts, 1) AS num, "
              "unnest(parts) AS offense_name "
              "FROM (SELECT id, string_split(offenses, ';') AS parts FROM incidents "
              "WHERE offenses IS NOT NULL))", ("incidents",)),
    "pivoted": ("SELECT id, name_cnt, "
                "count(num) FILTER (WHERE offense_name = '') AS not_named, "
                "count(num) FILTER (WHERE offense_name = 'A') AS a, "
                "count(num) FILTER (WHERE offense_name = 'F') AS f, "
                "count(num) FILTER (WHERE offense_name = 'N') AS n, "
                "count(num) FILTER (WHERE offense_name = 'O') AS o, "
                "count(num) FILTER (WHERE offense_name = 'R') AS r "
                "FROM names GROUP BY id, name_cnt", ("names",)),
    "big": ("SELECT date_trunc('hour', o_orderdate) AS datetime, n_name AS stn, count(o_orderkey) AS big FROM orders "
            "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL", ()),
    "hi": ("SELECT date_trunc('hour', l_shipdate) AS datetime, n_name AS stn, max(l_extendedprice) AS hi FROM lineitem "
           "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL", ()),
    "lo": (f"SELECT {_HOUR} AS datetime, event_type AS stn, min(value) AS lo FROM events GROUP BY ALL", ()),
    "measures": ("SELECT * FROM big FULL JOIN hi USING (datetime, stn) FULL JOIN lo USING (datetime, stn)",
                 ("big", "hi", "lo")),
    "wide": (f"SELECT {_HOUR} AS datetime, "
             "max(value) FILTER (WHERE event_type = 'click') AS click, "
             "max(value) FILTER (WHERE event_type = 'error') AS error, "
             "max(value) FILTER (WHERE event_type = 'purchase') AS purchase, "
             "max(value) FILTER (WHERE event_type = 'signup') AS signup, "
             "max(value) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1", ()),
    # the first day that any measure has: ids of days and hours follow by arithmetic
    "day_one": ("SELECT CAST(least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem), "
                "(SELECT min(ts) FROM events)) AS DATE) AS first_day", ()),
    "hours": ("SELECT CAST(range AS INTEGER) AS id, lpad(CAST(range AS VARCHAR), 2, '0') || ':00:00' AS hour "
              "FROM range(24)", ()),
    "fct_m": ("SELECT CAST(date_diff('day', first_day, CAST(datetime AS DATE)) + 1 AS INTEGER) AS date_id, "
              "CAST(extract(hour FROM datetime) AS INTEGER) AS hour_id, measures.* FROM measures, day_one "
              "WHERE datetime IS NOT NULL", ("measures", "day_one")),
    "bounds": ("SELECT least(CAST((SELECT min(o_orderdate) FROM orders) AS DATE), "
               "CAST((SELECT min(l_shipdate) FROM lineitem) AS DATE), DATE '1994-12-01') AS lo, "
               "greatest(CAST((SELECT max(o_orderdate) FROM orders) AS DATE), "
               "CAST((SELECT max(l_shipdate) FROM lineitem) AS DATE), CAST(NULL AS DATE)) AS hi", ()),
    "dates": ("SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS id, CAST(d AS DATE) AS date "
              "FROM range((SELECT CAST(lo AS TIMESTAMP) FROM bounds), "
              "(SELECT CAST(hi AS TIMESTAMP) FROM bounds) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)", ("bounds",)),
    # the day's number, if the dimension reaches it; no event of this binding has a time of day
    "fct_e": ("SELECT CASE WHEN day BETWEEN lo AND hi THEN CAST(date_diff('day', lo, day) + 1 AS INTEGER) END AS date_id, "
              "CAST(NULL AS INTEGER) AS hour_id, incidents.*, pivoted.* EXCLUDE (id) "
              "FROM incidents JOIN pivoted USING (id), bounds", ("incidents", "pivoted", "bounds")),
    # the whole build: its first day is a user bound or the first day of a date or measure
    "star_day": ("SELECT CAST(least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem), "
                 "TIMESTAMP '1994-12-01') AS DATE) AS first_day", ()),
    # a wide row has a cell for every nation, empty or not
    "cells": ("SELECT DISTINCT datetime, n_name AS stn FROM (SELECT datetime FROM big UNION ALL SELECT datetime FROM hi), "
              "nation", ("big", "hi")),
    "star_lines": ("SELECT DISTINCT 'S' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS ori, CAST(l_shipdate AS DATE) "
                   "AS incident_date, l_shipdate, CAST(trunc(l_quantity) AS INTEGER) AS adult_victim_count, "
                   "CASE WHEN l_quantity > 48 THEN NULL WHEN l_quantity < 2 THEN '' "
                   "ELSE l_returnflag || CASE WHEN l_discount >= 0.05 THEN ';' || l_returnflag ELSE '' END "
                   "|| ';' || l_linestatus || CASE WHEN l_tax = 0 THEN ';' ELSE '' END END AS offenses, "
                   "l_linestatus AS location_name FROM lineitem", ()),
    "star_ids": ("SELECT row_number() OVER (ORDER BY ori, l_shipdate, adult_victim_count, offenses NULLS FIRST, "
                 "location_name) AS id, string_split(offenses, ';') AS parts, * EXCLUDE (l_shipdate) FROM star_lines",
                 ("star_lines",)),
    "stations": ("SELECT DISTINCT n_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey", ()),
    "params": ("SELECT DISTINCT r_name, r_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey "
               "JOIN region ON n_regionkey = r_regionkey", ()),
}


def _with(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in FRAGMENTS[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({FRAGMENTS[n][0]})" for n in order) + "\n" + body


_AUDIT_COUNTS = ("SELECT (SELECT count(*) FROM (SELECT 1 FROM li GROUP BY l_orderkey, l_linenumber, "
                 "l_returnflag, l_linestatus HAVING count(*) > 1)) AS d, (SELECT count(*) FROM ir) AS c")

ORACLE_SQL: dict[str, str] = {
    "conform_clean": _with("SELECT * FROM (SELECT DISTINCT * FROM li) s WHERE NOT EXISTS (SELECT 1 FROM ir k "
                           "WHERE k.l_orderkey = s.l_orderkey AND k.l_linenumber = s.l_linenumber)", "ir"),
    "conform_quarantine": _with("SELECT * FROM (SELECT DISTINCT * FROM li) s WHERE EXISTS (SELECT 1 FROM ir k "
                                "WHERE k.l_orderkey = s.l_orderkey AND k.l_linenumber = s.l_linenumber)", "ir"),
    "conform_full_dupes": _with("SELECT l_orderkey, l_linenumber FROM li GROUP BY l_orderkey, l_linenumber, "
                                "l_returnflag, l_linestatus HAVING count(*) > 1", "li"),
    "conform_audit": _with("SELECT (SELECT count(*) FROM li) AS n_rows, (SELECT count(*) FROM (SELECT 1 FROM li "
                           "GROUP BY l_orderkey, l_linenumber, l_returnflag, l_linestatus HAVING count(*) > 1)) "
                           "AS full_dupe_groups, (SELECT count(*) FROM ir) AS conflicting_keys", "ir"),
    "audit_log": _with(
        f"SELECT 'stage' AS schema_name, 'lineitem' AS table_name, 'Duplicate records found for ' || d || "
        f"' keys of lineitem; see its full-duplicate key table.' AS message FROM ({_AUDIT_COUNTS}) WHERE d > 0 "
        f"UNION ALL SELECT 'stage', 'lineitem', c || ' keys of lineitem have inconsistent records; they were "
        f"moved to its quarantine table.' FROM ({_AUDIT_COUNTS}) WHERE c > 0 "
        f"UNION ALL SELECT 'stage', 'lineitem', 'No duplicate or inconsistent records found in lineitem.' "
        f"FROM ({_AUDIT_COUNTS}) WHERE d = 0 AND c = 0", "ir"),
    "conform_clean_docs": _with("SELECT * FROM (SELECT DISTINCT * FROM docs) s WHERE NOT EXISTS "
                                "(SELECT 1 FROM docs_ir k WHERE k.text = s.text)", "docs_ir"),
    "conform_quarantine_docs": _with("SELECT * FROM (SELECT DISTINCT * FROM docs) s WHERE EXISTS "
                                     "(SELECT 1 FROM docs_ir k WHERE k.text = s.text)", "docs_ir"),
    "key_surplus": "SELECT count(text) - count(DISTINCT text) AS surplus FROM documents",
    "pk_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                     "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "pk_violations_sorted": "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey "
                            "HAVING count(*) > 1",
    "fk_orphans": "SELECT doc_id, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
                  "GROUP BY doc_id",
    "fk_orphans_dense": "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN "
                        "(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey",
    "length_violations": "SELECT p_partkey, p_name, CAST(length(p_name) AS INTEGER) AS len FROM part "
                         "WHERE length(p_name) > 10",
    "length_violations_all": "SELECT p_partkey, 'p_name' AS column, CAST(length(p_name) AS INTEGER) AS len "
                             "FROM part WHERE length(p_name) > 10 "
                             "UNION ALL SELECT p_partkey, 'p_brand', CAST(length(p_brand) AS INTEGER) FROM part "
                             "WHERE length(p_brand) > 7 "
                             "UNION ALL SELECT p_partkey, 'p_type', CAST(length(p_type) AS INTEGER) FROM part "
                             "WHERE length(p_type) > 6",
    "conflicting_keys": _with("SELECT * FROM ir", "ir"),
    "dedup_log": "SELECT 'stage' AS schema_name, 'lineitem' AS table_name, 'Duplicate records found in ' || n || "
                 "' groups of lineitem; repeats were removed.' AS message FROM (SELECT count(*) AS n FROM "
                 "(SELECT count(*) AS c FROM lineitem GROUP BY l_partkey, l_suppkey, l_returnflag) WHERE c > 1) "
                 "WHERE n > 0 UNION ALL SELECT 'stage', 'lineitem', "
                 "'No duplicate or inconsistent records found in lineitem.' FROM (SELECT count(*) AS n FROM "
                 "(SELECT count(*) AS c FROM lineitem GROUP BY l_partkey, l_suppkey, l_returnflag) WHERE c > 1) "
                 "WHERE n = 0",
    "slug_key": "SELECT replace(p_name, ' ', '_') AS slug, * FROM part",
    "surrogate_ids": "SELECT CAST(row_number() OVER (ORDER BY l_partkey, l_suppkey, l_returnflag) AS BIGINT) AS id, "
                     "l_partkey, l_suppkey, l_returnflag, count(*) - 1 AS group_dupe_cnt FROM lineitem "
                     "GROUP BY l_partkey, l_suppkey, l_returnflag",
    "dedup_audit": "SELECT count(*) AS dupe_count FROM (SELECT count(*) - 1 AS group_dupe_cnt FROM lineitem "
                   "GROUP BY l_partkey, l_suppkey, l_returnflag) WHERE group_dupe_cnt > 0",
    "clean_events": "SELECT CAST(row_number() OVER (ORDER BY l_partkey, l_suppkey, l_returnflag, l_shipdate) "
                    "AS BIGINT) AS id, l_partkey, l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate, "
                    "CAST(NULL AS VARCHAR) AS incident_time FROM lineitem "
                    "GROUP BY l_partkey, l_suppkey, l_returnflag, l_shipdate",
    "compound": _with("SELECT * FROM compound", "compound"),
    "incidents": _with("SELECT * FROM incidents", "incidents"),
    "split_rows": _with("SELECT * FROM names", "names"),
    "vocabulary": _with("SELECT DISTINCT offense_name FROM names", "names"),
    "pivot_counts": _with("SELECT * FROM pivoted", "pivoted"),
    "pivot_flags": _with("SELECT id, name_cnt, not_named > 0 AS not_named, a > 0 AS a, f > 0 AS f, "
                         "n > 0 AS n, o > 0 AS o, r > 0 AS r FROM pivoted", "pivoted"),
    "unpivot_measures": _with("SELECT datetime, stn, v FROM wide UNPIVOT INCLUDE NULLS "
                              "(v FOR stn IN (click, error, purchase, signup, view))", "wide"),
    "full_join": _with("SELECT * FROM measures", "measures"),
    "full_join_repeated": "SELECT * FROM (SELECT CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, "
                          "o_custkey % 25 AS k, o_orderkey FROM orders) "
                          "FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS day, CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey % 25 END AS k, "
                          "l_extendedprice FROM lineitem WHERE l_linenumber = 1) USING (day, k) "
                          "FULL JOIN (SELECT CAST(DATE '1995-01-01' + CAST(p_partkey % 900 AS INTEGER) AS DATE) AS day, "
                          "p_partkey % 25 AS k, p_retailprice FROM part) USING (day, k)",
    "union_measures": _with("SELECT * FROM measures", "measures"),
    "date_bounds": _with("SELECT * FROM bounds", "bounds"),
    "dim_dates": _with("SELECT * FROM dates", "dates"),
    "dim_hours": _with("SELECT h.id, h.hour, count(e.event_id) AS n_events FROM hours h LEFT JOIN events e "
                       "ON extract(hour FROM e.ts) = h.id GROUP BY h.id, h.hour", "hours"),
    "fct_measures": _with("SELECT * FROM fct_m", "fct_m"),
    "fct_events": _with("SELECT * FROM fct_e", "fct_e"),
    "fct_events_joined": _with("SELECT * FROM fct_e", "fct_e"),
    "pivot_lists": _with("SELECT * FROM pivoted", "pivoted"),
    "fct_readback": _with("SELECT * FROM fct_m", "fct_m"),
    "fct_range": _with("SELECT * FROM fct_m WHERE stn BETWEEN 'NATION_10' AND 'NATION_17' AND date_id BETWEEN 100 AND 400", "fct_m"),
    "bucketed_join": "SELECT o_orderkey, count(*) AS n, max(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) "
                     "AS longest FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey",
    "star_daily": _with("SELECT CAST(datetime AS DATE) AS date, max(hi) AS hi, min(lo) AS lo, "
                        "CAST(sum(big) AS BIGINT) AS big, count(*) AS n_rows FROM measures GROUP BY 1", "measures"),
    "schema_ddl": _with("SELECT p.r_name AS tbl_name, 'datetime DATETIME, ' || string_agg(s.n_name || ' DECIMAL(6, ' || "
                        "p.r_regionkey || ')', ', ' ORDER BY s.n_nationkey) AS col_defs FROM params p, stations s "
                        "GROUP BY p.r_name", "params", "stations"),
    "schema_types": _with("SELECT p.r_name AS tbl_name, 'struct<datetime:timestamp_ntz,' || string_agg(s.n_name || "
                          "':decimal(6,' || p.r_regionkey || ')', ',' ORDER BY s.n_nationkey) || '>' AS struct "
                          "FROM params p, stations s GROUP BY p.r_name", "params", "stations"),
    "param_order": "SELECT p_brand, CAST(rank() OVER (ORDER BY p_brand) AS INTEGER) AS num "
                   "FROM (SELECT DISTINCT p_brand FROM part)",
    "csv_texts": "SELECT doc_id, text, '\"' || source || '\\\\\",' AS quoted, CAST(n_chars / 8 AS DECIMAL(12,3)) AS eighth, "
                 "n_chars % 2 = 0 AS even, TIMESTAMP '2020-01-01' + to_seconds(doc_id) AS written FROM documents",
    "csv_times": "SELECT event_id, TIMESTAMP '2021-03-14' + to_seconds(event_id % 43200) AS at FROM events",
    "load_rows": "SELECT doc_id, text, CAST(n_chars AS INTEGER) AS n_chars, source FROM documents "
                 "WHERE n_chars % 20 NOT IN (3, 7, 11)",
    "load_errors": "SELECT doc_id, CASE n_chars % 20 WHEN 3 THEN 'n_chars' WHEN 7 THEN 'source' END AS column, "
                   "CASE n_chars % 20 WHEN 3 THEN 'not a int' WHEN 7 THEN 'missing' ELSE 'not 4 fields' END AS reason, "
                   "CASE n_chars % 20 WHEN 3 THEN 'x' || n_chars END AS value FROM documents WHERE n_chars % 20 IN (3, 7, 11)",
    "files_loaded": "SELECT 'customer' AS target, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad FROM customer "
                    "UNION ALL SELECT 'supplier', count(*), 0 FROM supplier",
    "name_counts": _with("SELECT id, name_cnt, offense_name, count(*) AS n FROM names GROUP BY ALL", "names"),
    "fct_events_timed": _with(
        "SELECT CAST(date_diff('day', first_day, CAST(reported AS DATE)) + 1 AS INTEGER) AS date_id, "
        "CAST(extract(hour FROM reported) AS INTEGER) AS hour_id, row_number() OVER (ORDER BY offenses, reported) AS id, offenses, "
        "CAST(reported AS DATE) AS day, strftime(reported, '%H:%M:%S') AS incident_time, CAST(1 AS BIGINT) AS name_cnt, "
        + ", ".join(f"CAST(offenses = '{x}' AS BIGINT) AS {x}" for x in ("click", "error", "purchase", "signup", "view"))
        + f" FROM (SELECT DISTINCT event_type AS offenses, {_HOUR} AS reported FROM events), day_one", "day_one"),
    "log_appended": "SELECT 'stage' AS schema_name, 'lineitem' AS table_name, 'Duplicate records found in ' || n || "
                    "' groups of lineitem; repeats were removed.' AS message FROM (SELECT count(*) AS n FROM "
                    "(SELECT 1 FROM lineitem GROUP BY l_partkey, l_suppkey, l_returnflag HAVING count(*) > 1)), range(2) "
                    "WHERE n > 0",
    "star_measures": _with(
        "SELECT CAST(date_diff('day', first_day, CAST(datetime AS DATE)) + 1 AS INTEGER) AS date_id, "
        "CAST(extract(hour FROM datetime) AS INTEGER) AS hour_id, datetime, stn, big, CAST(hi AS DECIMAL(12, 2)) AS hi "
        "FROM cells LEFT JOIN big USING (datetime, stn) LEFT JOIN hi USING (datetime, stn), star_day",
        "cells", "big", "hi", "star_day"),
    "star_incidents": _with(
        "SELECT CAST(date_diff('day', first_day, incident_date) + 1 AS INTEGER) AS date_id, id, ori, incident_date, "
        "adult_victim_count, offenses, location_name, len(parts) AS name_cnt, "
        + ", ".join(f"CAST(len(list_filter(parts, lambda x: x = '{x}')) AS BIGINT) AS {x.lower() or 'not_named'}"
                    for x in ("", "A", "F", "N", "O", "R"))
        + " FROM star_ids, star_day WHERE offenses IS NOT NULL", "star_ids", "star_day"),
    "table_replaced": "SELECT * FROM orders",
    "table_rewritten": "SELECT c_custkey, max(c_acctbal) OVER (PARTITION BY c_nationkey) - c_acctbal AS behind FROM customer",
    "rows_inserted": _with(
        "SELECT row_number() OVER (ORDER BY l_orderkey, day, offenses NULLS FIRST) AS id, * FROM "
        "(SELECT DISTINCT * FROM compound WHERE day < DATE '1996-01-01') UNION ALL "
        "SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM compound WHERE day < DATE '1996-01-01')) "
        "+ row_number() OVER (ORDER BY l_orderkey, day, offenses NULLS FIRST) AS id, * FROM "
        "(SELECT DISTINCT * FROM compound WHERE day >= DATE '1996-01-01')", "compound"),
    "csv_scan": "SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part",
}
