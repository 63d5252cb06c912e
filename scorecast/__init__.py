"""scorecast: review-text analytics and score prediction on Spark.

Subpackages
-----------
sources    table loading, fixture adapters, file sources and sinks
functions  column expressions (text statistics, tokens, time arithmetic, vectors)
operators  DataFrame operators (cleaning, time series, text features, topics,
           splits, models, selection)
plans      composed queries and the registry used by ``__spark_entry__``
streaming  Structured Streaming forms of the incremental operators
"""

__version__ = "0.1.0"
