"""shelfwise: rating-driven book recommendations on Spark.

Batch and streaming recommendation jobs expressed with the DataFrame API,
``pyspark.ml`` (ALS, k-means) and Structured Streaming.  Every function takes
and returns DataFrames; the SparkSession, paths and seeds are arguments.

Sub-packages
------------
sources    text parsing with quarantine, keyed Parquet tables (change log)
functions  column-expression helpers (vectors, lists, hash split)
operators  features, factor models, clusters, evaluation
plans      bootstrap and retrain jobs
streaming  file feeds and their micro-batch handlers
"""

__version__ = "0.1.0"
