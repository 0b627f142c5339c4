"""tiffin: a bronze / silver / gold batch pipeline for food-delivery data on Spark.

Everything is a function from DataFrames to DataFrames, built from native Spark expressions.
"""
