"""autoscope: a Spark-native listings-to-price-model analytics package.

Every operator is a ``DataFrame -> DataFrame`` function (or a thin
``pyspark.ml`` wrapper).  Sub-packages:

* ``sources``   -- scans, sinks and the test-data adapter
* ``functions`` -- column-expression builders (the cleaning rules)
* ``operators`` -- profiling, statistics, joins, imputation, splits,
                   features, models and evaluation
* ``plans``     -- whole jobs (prepare / means / features / train) and the
                   registry of named queries with their SQL twins
* ``streaming`` -- incremental variant of the prepare job
"""

__version__ = "0.1.0"
