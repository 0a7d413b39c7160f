"""Cleaning, hourly counting, profiling and auditing of toll-gantry trips and flows on Spark.

Every operator takes DataFrames and returns a lazy DataFrame built from Spark's own functions;
nothing is collected, no Python UDF runs, and Spark decides partitioning and join strategy.
"""
