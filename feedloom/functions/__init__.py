"""Column-level helpers (built-in Spark expressions only)."""

from .flags import (array_has, as_of_date, parse_release_date, ratio, self_published,
                    very_indie)
from .json_fields import (as_structs, cents_to_price, json_scalar,
                          parse_details_raw, to_bool, to_long)

__all__ = [
    "array_has", "as_of_date", "as_structs", "cents_to_price",
    "json_scalar", "parse_details_raw", "parse_release_date", "ratio",
    "self_published", "to_bool", "to_long", "very_indie",
]
