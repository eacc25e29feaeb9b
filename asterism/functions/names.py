"""Naming rules for columns made from data values (pivot columns)."""

from __future__ import annotations

from collections.abc import Iterable

# Fixed value: the column name given to the empty name, which Spark would
# otherwise turn into a column called ''.
EMPTY_NAME_COLUMN = "not_named"


def pivot_column_name(value: str) -> str:
    """Documented pivot columns are the lower-cased names; the empty name is ``not_named``."""
    return value.lower() if value != "" else EMPTY_NAME_COLUMN


def pivot_column_names(values: Iterable[str], reserved: Iterable[str] = ()) -> dict[str, str]:
    """Map each value to its column name; raise when two values would share a column.

    Spark resolves names case-insensitively, so ``A`` and ``a`` would be ambiguous.
    """
    taken = {r.lower(): f"column {r!r}" for r in reserved}
    out: dict[str, str] = {}
    for value in values:
        if value is None:
            raise ValueError("a NULL name cannot become a column")
        name = pivot_column_name(value)
        if name.lower() in taken:
            raise ValueError(f"names {taken[name.lower()]} and {value!r} map to the same column {name!r}")
        taken[name.lower()] = repr(value)
        out[value] = name
    return out
