"""Operators for preparing training data (texts, pages, tokens) on Spark.

Each module holds one operator; ``queries`` registers them for the driver.
Nothing outside this package imports it.
"""
