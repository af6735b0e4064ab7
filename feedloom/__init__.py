"""feedloom: batch analytics for dated product-catalog feeds on Spark.

Layers:

* ``sources``   – dated JSONL feeds, raw day-partitioned tables, sinks
* ``functions`` – Column helpers (JSON paths, flags, dates, ratios)
* ``operators`` – DataFrame → DataFrame operators (latest per key, key sets)
* ``plans``     – the staging / mart models, incremental key selection,
                  payload normalisers and the composed batch jobs
"""

from .session import checkpoint_root, get_session, scratch_dir

__all__ = ["checkpoint_root", "get_session", "scratch_dir"]
