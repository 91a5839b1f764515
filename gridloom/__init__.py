"""gridloom: table-in, table-out model jobs on Spark DataFrames.

A job names a SQL text, the rows become points, baskets, ratings or edges, one
model is trained per point of a parameter grid, every point is measured with a
distributed aggregate, and models and predictions are kept in tables.
"""
