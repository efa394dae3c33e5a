"""Order-and-delivery marketplace analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame. Reading, writing and
session settings stay with the caller (see ``sources``).
"""
