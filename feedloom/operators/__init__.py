"""DataFrame → DataFrame operators."""

from .filters import off_day, on_day, only_success, released
from .keys import (dedup_ordered, file_position, limit_pending, nonnull_keys,
                   pending_keys, processed_keys, to_key, truthy,
                   union_processed)
from .latest import latest_per_key

__all__ = [
    "dedup_ordered", "file_position", "latest_per_key", "limit_pending",
    "nonnull_keys", "off_day", "on_day", "only_success", "pending_keys",
    "processed_keys", "released", "to_key", "truthy", "union_processed",
]
