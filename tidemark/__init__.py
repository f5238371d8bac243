"""Extract tables, merge Parquet datasets and build packed grids with Spark.

The library is a set of DataFrame operators (``operators``, ``functions``), readers and
writers (``sources``), composed jobs (``plans``) and Structured Streaming queries
(``streaming``).  Nothing is evaluated in Python: every row is processed by Spark built-ins.
"""
