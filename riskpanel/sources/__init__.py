from riskpanel.sources.readers import (
    SourceConfig,
    jdbc_options,
    jdbc_predicates,
    max_date,
    read_alt_params,
    read_calendar,
    read_panel,
    read_snapshot,
    read_source,
    source_max_date,
    staging_watermark,
)
from riskpanel.sources.writers import (
    audit_counts,
    delete_statement,
    replace_by_key,
    warehouse_options,
    write_partitions,
    write_snapshot,
)

__all__ = [
    "SourceConfig",
    "audit_counts",
    "delete_statement",
    "jdbc_options",
    "jdbc_predicates",
    "max_date",
    "read_alt_params",
    "read_calendar",
    "read_panel",
    "read_snapshot",
    "read_source",
    "replace_by_key",
    "source_max_date",
    "staging_watermark",
    "warehouse_options",
    "write_partitions",
    "write_snapshot",
]
