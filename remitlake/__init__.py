"""Payments and exchange-rate analytics on Spark.

``streaming`` lands a mixed message stream, ``plans`` holds the daily jobs built from ``operators``
(DataFrame in, DataFrame out), ``sources`` reads and writes topics, tables, files and databases,
``functions`` holds column expressions.
"""
