"""The six pipelines and the catalog report, built from the operators.

Each ``run(spark, ...)`` takes file inputs (the live HTTP clients of the
original are replaced by files or a fetcher) and writes tables or paths.
"""
