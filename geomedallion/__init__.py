"""Medallion (bronze / silver / gold) operators for geographic feeds, on Spark DataFrames.

Sub-packages:
  functions  Column expressions (no Python UDFs)
  operators  DataFrame -> DataFrame operators (joins, windows, merges, checks)
  sources    landed payload and CSV readers
  sinks      table and CSV writers
  plans      bronze / silver / gold compositions and the supplied-table workloads
  streaming  file-stream front end for the bronze layer
"""

__version__ = "0.1.0"
