"""Tidemark: customer-retention analytics written as Spark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame. The caller owns
the SparkSession.
"""
