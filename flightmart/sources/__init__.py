"""Sources: raw CSV sets, lookup CSVs, staged Parquet, benchmark adapters."""

from .adapters import (
    adapter,
    adapter_sql,
    raw_airports,
    raw_carriers,
    raw_flights,
    raw_planes,
    raw_variables,
    year_span,
)
from .files import (
    csv_header,
    path_exists,
    read_csv_inferred,
    read_csv_strings,
    read_stage,
    resolve_sources,
    string_schema,
    year_paths,
)
from .headers import header_drift, header_map, read_csv_by_name

__all__ = [
    "adapter",
    "adapter_sql",
    "csv_header",
    "header_drift",
    "header_map",
    "path_exists",
    "raw_airports",
    "raw_carriers",
    "raw_flights",
    "raw_planes",
    "raw_variables",
    "year_span",
    "read_csv_by_name",
    "read_csv_inferred",
    "read_csv_strings",
    "read_stage",
    "resolve_sources",
    "string_schema",
    "year_paths",
]
