"""Screening of large threaded-discussion archives as Spark DataFrame operators."""
