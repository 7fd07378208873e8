from .digests import changed_partitions, digest_tree, fingerprint, overwrite_snapshot, snapshot_changes
from .readers import (
    append_flows,
    infer_schema,
    load_schema,
    read_catalog,
    read_events,
    read_table,
    stream_events,
    stream_table,
    with_audit,
)
from .writers import (
    apply_changes,
    changed_rows,
    comment_table,
    export_coefficients,
    export_examples,
    get_properties,
    latest_per_key,
    overwrite,
    overwrite_table,
    set_properties,
    stream_to_table,
    with_month_partitions,
)

__all__ = [
    "append_flows",
    "apply_changes",
    "changed_partitions",
    "changed_rows",
    "comment_table",
    "digest_tree",
    "export_coefficients",
    "export_examples",
    "fingerprint",
    "get_properties",
    "infer_schema",
    "latest_per_key",
    "load_schema",
    "overwrite",
    "overwrite_snapshot",
    "overwrite_table",
    "read_catalog",
    "read_events",
    "read_table",
    "set_properties",
    "snapshot_changes",
    "stream_events",
    "stream_table",
    "stream_to_table",
    "with_audit",
    "with_month_partitions",
]
