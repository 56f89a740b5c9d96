"""tabprep: tabular preparation, profiling and classifier evaluation on Spark.

Subpackages: ``functions`` (column expressions), ``sources`` (readers and
derived views), ``operators`` (DataFrame -> DataFrame operators),
``plans`` (composites, the registered queries and their oracles) and
``streaming`` (the row-local operators on Structured Streaming).
"""

__version__ = "0.1.0"
