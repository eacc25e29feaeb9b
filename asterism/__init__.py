"""asterism: build an analytic star schema from raw files with Spark DataFrame plans.

Every operator takes and returns DataFrames; nothing here holds a global session.
"""

from asterism.operators.events import (
    clean_events,
    dedup_audit,
    dedup_with_count,
    with_surrogate_id,
)
from asterism.operators.facts import (
    build_event_fact,
    build_event_fact_from_lists,
    build_measure_fact,
)
from asterism.operators.generators import date_bounds, dim_dates, dim_dates_between, dim_hours
from asterism.operators.quality import (
    add_slug_key,
    audit_rows,
    check_all_lengths,
    check_foreign_key,
    check_lengths,
    check_unique,
    conflicting_keys,
    conform_dimension,
    full_duplicate_keys,
    key_surplus,
    with_typed_null,
)
from asterism.operators.reshape import (
    count_list_names,
    full_join_measures,
    list_vocabulary,
    number_names,
    pivot_counts,
    split_to_rows,
    union_measures,
    unpivot_measures,
    vocabulary,
    vocabulary_frame,
)
from asterism.operators.schema import measure_schemas, schema_ddl_frame
from asterism.sources.csv import (
    read_manifest,
    read_measure_csv,
    read_ordered_names,
    read_positional_csv,
)
from asterism.sources.sinks import append_log, write_fact, write_table

__all__ = [
    "add_slug_key",
    "append_log",
    "audit_rows",
    "build_event_fact",
    "build_event_fact_from_lists",
    "build_measure_fact",
    "check_all_lengths",
    "check_foreign_key",
    "check_lengths",
    "check_unique",
    "clean_events",
    "conflicting_keys",
    "count_list_names",
    "conform_dimension",
    "date_bounds",
    "dedup_audit",
    "dedup_with_count",
    "dim_dates",
    "dim_dates_between",
    "dim_hours",
    "full_duplicate_keys",
    "full_join_measures",
    "key_surplus",
    "list_vocabulary",
    "measure_schemas",
    "number_names",
    "pivot_counts",
    "read_manifest",
    "read_measure_csv",
    "read_ordered_names",
    "read_positional_csv",
    "schema_ddl_frame",
    "split_to_rows",
    "union_measures",
    "unpivot_measures",
    "vocabulary",
    "vocabulary_frame",
    "with_surrogate_id",
    "with_typed_null",
    "write_fact",
    "write_table",
]
