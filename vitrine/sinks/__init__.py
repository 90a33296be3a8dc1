from vitrine.sinks.incremental import forget_newest, newest_versions, update_activity, update_intervals, update_newest
from vitrine.sinks.tables import (
    append_table,
    drop_table,
    footer_count,
    layer_namespace,
    merge_table,
    namespace_tables,
    recover_table,
    stored_row_count,
    write_table,
    write_view,
)

__all__ = [
    "append_table",
    "drop_table",
    "footer_count",
    "forget_newest",
    "layer_namespace",
    "merge_table",
    "namespace_tables",
    "newest_versions",
    "recover_table",
    "stored_row_count",
    "update_activity",
    "update_intervals",
    "update_newest",
    "write_table",
    "write_view",
]
