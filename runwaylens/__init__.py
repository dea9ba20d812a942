"""Batch analytics for delay-style fact tables, written as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns) and stays lazy
unless its name says that it writes.
"""
