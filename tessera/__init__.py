"""tessera: DataFrame-in, DataFrame-out analytics on Spark.

Table verbs, group statistics, hash sampling, partition/group functions over
Arrow, MLlib model fits with tidy summaries, and survival statistics
(censoring, Kaplan-Meier, log-rank, Cox) computed on event-time tables.
Every function builds a lazy plan and leaves physical planning to Catalyst.
"""

__version__ = "0.1.0"

# Functions of this package run inside Python workers (pandas UDFs, mapInPandas,
# applyInPandas). Pickle them by value so executors need no installed copy.
from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(__import__(__name__))
