"""loanlens: mortgage-default analytics on Spark DataFrames, Spark SQL and pyspark.ml.

Layout:

* ``sources``   -- pipe-text / bzip2 / legacy tuple-text readers and writers,
                   Parquet landing and sinks, stand-in records from the driver tables
* ``functions`` -- scalar column expressions (blank handling, safe casts, dates, labels)
* ``operators`` -- DataFrame -> DataFrame operators (cleaning, labels, features,
                   statistics, models, evaluation, reports)
* ``plans``     -- end-to-end jobs, the command-line jobs, the query registry and
                   its DuckDB oracle
* ``streaming`` -- the performance-file operators over arriving files
"""

__version__ = "0.1.0"
