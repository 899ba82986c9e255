from .control import read_watermark, seed_watermark, upsert_watermark, with_zone
from .history import apply_history, changed_members, member_changes, resolve_inferred
from .lookup import Lookup, inferred_members, lookup_key, lookup_keys, missing_members
from .members import conform, except_distinct, insert_new, one_per_key, rows_not_in
from .numbering import assign_keys, max_key, number_in_groups, ordered_index
from .profile import distinct_values, load_stats, preview
from .skew import are_small, hot_keys, is_small, skew_join

__all__ = [
    "Lookup",
    "apply_history",
    "are_small",
    "assign_keys",
    "changed_members",
    "conform",
    "distinct_values",
    "except_distinct",
    "hot_keys",
    "inferred_members",
    "insert_new",
    "is_small",
    "load_stats",
    "lookup_key",
    "lookup_keys",
    "max_key",
    "missing_members",
    "number_in_groups",
    "one_per_key",
    "ordered_index",
    "preview",
    "read_watermark",
    "resolve_inferred",
    "rows_not_in",
    "seed_watermark",
    "skew_join",
    "upsert_watermark",
    "with_zone",
]
