"""tripmart: a monthly trip-record mart built with Spark DataFrames.

Layers: ``sources`` (file scans, lookups, test fixture), ``functions``
(column expressions), ``operators`` (staging, dimension, fact, marts, data
quality), ``incremental`` (incremental loading), ``plans`` (sinks, pipeline,
registered queries).
"""

__version__ = "0.1.0"
