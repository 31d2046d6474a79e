"""Batch and streaming analytics operators written directly on Spark DataFrames.

Every operator takes and returns DataFrames, so operators compose with
``DataFrame.transform`` and Catalyst sees one plan from scan to sink.
"""
