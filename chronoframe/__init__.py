"""chronoframe: point-in-time feature computation and offline evaluation on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark SQL expressions, windows, joins and
aggregations; Python on the data path is limited to the Arrow-batched stateful
stream processor in ``chronoframe.streaming`` and the Arrow form of the hash.
"""

__version__ = "0.1.0"
