from .groups import attach_group_values, last_per_key
from .lookup import fits_broadcast, lookup_join
from .merge import append_new, duplicate_keys, joined_update, require_unique, upsert
from .unpivot import described, fixed, unpivot_charges

__all__ = [
    "append_new", "attach_group_values", "described", "duplicate_keys", "fits_broadcast", "fixed", "joined_update",
    "last_per_key", "lookup_join", "require_unique", "unpivot_charges", "upsert",
]
