from .batches import (
    add_members,
    append_batch,
    clear_batch,
    commit_batch,
    committed,
    create_batched,
    create_versioned,
    current_versions,
    last_batch,
    versions,
    write_batch,
    write_versions,
)
from .keys import KeyLog
from .tables import append_table, create_tables, describe_table, rewrite_table, write_bucketed, write_staging

__all__ = [
    "KeyLog",
    "add_members",
    "append_batch",
    "append_table",
    "clear_batch",
    "commit_batch",
    "committed",
    "create_batched",
    "create_tables",
    "create_versioned",
    "current_versions",
    "describe_table",
    "last_batch",
    "rewrite_table",
    "versions",
    "write_batch",
    "write_bucketed",
    "write_staging",
    "write_versions",
]
