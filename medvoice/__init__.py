"""Analytics for patient review tables and review streams, on Spark.

Every public function takes and returns DataFrames (or Columns) and stays lazy;
only functions that fit a model, write files or run a stream start jobs.
"""

__version__ = "0.1.0"
