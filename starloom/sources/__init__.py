from .calendar import calendar_days
from .footers import footer_bounds, known_bounds
from .freshness import changed_sources, is_built_from, manifest, manifest_path, mark_built
from .landing import file_changes, land, landed_files, listed_files
from .scans import scan_checked, scan_delimited, scan_parquet, scan_source
from .schemas import (
    BATCHED_TABLES,
    FLOAT_WRITTEN_IDS,
    ORDER_MONTH,
    SOURCE_TABLES,
    STAGING_SOURCES,
    VERSIONED_TABLES,
    WAREHOUSE_TABLES,
    schema_of,
)

__all__ = [
    "BATCHED_TABLES",
    "FLOAT_WRITTEN_IDS",
    "ORDER_MONTH",
    "SOURCE_TABLES",
    "STAGING_SOURCES",
    "VERSIONED_TABLES",
    "WAREHOUSE_TABLES",
    "calendar_days",
    "changed_sources",
    "file_changes",
    "footer_bounds",
    "is_built_from",
    "known_bounds",
    "land",
    "landed_files",
    "listed_files",
    "manifest",
    "manifest_path",
    "mark_built",
    "scan_checked",
    "scan_delimited",
    "scan_parquet",
    "scan_source",
    "schema_of",
]
