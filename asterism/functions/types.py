"""Warehouse type names → Spark DDL types (used to build schemas from spec tables)."""

from __future__ import annotations

import re

# How the warehouse types of the source specs map to Spark types.
# DATETIME/TIMESTAMP carry no zone; TIME is kept as 'HH:MM:SS' text so nothing
# depends on Spark's optional TIME type; VARCHAR(n) lengths are checked
# separately (check_lengths) because CSV schemas reject varchar(n).
_SIMPLE = {
    "DATETIME": "TIMESTAMP_NTZ",
    "TIMESTAMP": "TIMESTAMP_NTZ",
    "TIMESTAMP WITHOUT TIME ZONE": "TIMESTAMP_NTZ",
    "DATE": "DATE",
    "TIME": "STRING",
    "FLOAT": "DOUBLE",
    "FLOAT8": "DOUBLE",
    "DOUBLE PRECISION": "DOUBLE",
    "REAL": "FLOAT",
    "INT": "INT",
    "INTEGER": "INT",
    "INT4": "INT",
    "SMALLINT": "SMALLINT",
    "BIGINT": "BIGINT",
    "INT8": "BIGINT",
    "BOOLEAN": "BOOLEAN",
    "BOOL": "BOOLEAN",
    "TEXT": "STRING",
}

_VARCHAR = re.compile(r"^(N?VARCHAR|CHARACTER VARYING|CHAR|CHARACTER|NCHAR|BPCHAR)\s*(\(\s*(\d+|MAX)\s*\))?$")
_DECIMAL = re.compile(r"^(DECIMAL|NUMERIC)\s*\(\s*(\d+)\s*(,\s*(\d+)\s*)?\)$")


def spark_type(warehouse_type: str) -> str:
    """Spark DDL type for one warehouse type name, e.g. ``DECIMAL(5, 2)`` → ``DECIMAL(5,2)``."""
    t = " ".join(warehouse_type.strip().upper().split())
    if t in _SIMPLE:
        return _SIMPLE[t]
    if _VARCHAR.match(t):
        return "STRING"
    m = _DECIMAL.match(t)
    if m:
        return f"DECIMAL({m.group(2)},{m.group(4) or 0})"
    raise ValueError(f"unsupported column type {warehouse_type!r}")


def varchar_length(warehouse_type: str) -> int | None:
    """Declared length of a VARCHAR(n) type, or None (no limit / not a string)."""
    m = _VARCHAR.match(" ".join(warehouse_type.strip().upper().split()))
    if m and m.group(3) and m.group(3) != "MAX":
        return int(m.group(3))
    return None
