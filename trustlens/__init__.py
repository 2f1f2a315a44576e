"""trustlens: review-count-aware product rating analytics on Spark.

Every public operator is a function ``DataFrame(s), params -> DataFrame``.
Sub-packages:

- ``sources``   readers, writers and the test fixtures derived from the
                driver tables
- ``functions`` column-level helpers (parsing, rounding, ranking formulas,
                size-checked joins, global rank)
- ``operators`` cleaning, trust rating, profiling, features, models,
                explanations, purchase guide
- ``plans``     session setup and end-to-end pipelines
- ``streaming`` the purchase-guide scorer over a file stream
"""

__version__ = "0.1.0"
