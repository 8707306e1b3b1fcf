"""cartwheel — shop-event analytics as plain Spark DataFrame functions.

Layers (each a set of ``(DataFrame, ...) -> DataFrame`` functions):

* ``sources``   raw inputs (fixture adapter over the driver tables, nested export), sinks
* ``functions`` small Column helpers shared by every layer
* ``operators`` staging, sessions, marts, ranking metrics, data-quality checks, run ledger
* ``plans``     multi-step plans: point-in-time feature store, propensity model, full DAG
* ``streaming`` incremental intake of raw events (micro-batches through the staging rules)
"""

__all__ = ["session"]
