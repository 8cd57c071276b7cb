"""Spark-native reservation analytics: bronze, silver, gold, quality, streaming.

Every public function takes and returns DataFrames (or Columns) and stays
lazy unless its docstring says that it runs a job.
"""
