"""DataFrame -> DataFrame operators (lazy; usable with ``df.transform``)."""

from .clean import (
    assemble_date,
    cast_columns,
    fill_const,
    fill_expr,
    fill_from,
    fill_missing,
    flag_missing,
    int_difference,
    parse_dates,
    relabel_missing,
    strip_non_ascii,
)
from .digest import content_digest
from .filters import require_not_null, require_present, rows_missing, rows_with_values
from .keys import duplicate_keys, key_sketches, merged_key_profile
from .layout import cut_points, file_ranges, with_zorder_key
from .override import mapping_frame, override_by_key
from .profile import (
    flag_counts,
    key_profile,
    merge_audits,
    missing_audit,
    nan_audit,
    non_null_count,
    peek,
    row_count,
    schema_profile,
    schema_rows,
    staged_audit,
    step_counts,
)
from .projection import drop_columns, rename, select_columns
from .rejects import cast_with_rejects, reject_counts, reject_ledger, typed_rows

__all__ = [
    "assemble_date",
    "cast_columns",
    "cast_with_rejects",
    "content_digest",
    "cut_points",
    "drop_columns",
    "duplicate_keys",
    "file_ranges",
    "fill_const",
    "fill_expr",
    "fill_from",
    "fill_missing",
    "flag_counts",
    "flag_missing",
    "int_difference",
    "key_profile",
    "key_sketches",
    "mapping_frame",
    "merge_audits",
    "merged_key_profile",
    "missing_audit",
    "nan_audit",
    "non_null_count",
    "override_by_key",
    "parse_dates",
    "peek",
    "reject_counts",
    "reject_ledger",
    "relabel_missing",
    "rename",
    "require_not_null",
    "require_present",
    "row_count",
    "rows_missing",
    "rows_with_values",
    "schema_profile",
    "schema_rows",
    "select_columns",
    "staged_audit",
    "step_counts",
    "strip_non_ascii",
    "typed_rows",
    "with_zorder_key",
]
