"""Layered analytics over grid-activity and commerce tables, written for Spark.

Every operator is a function from DataFrame to DataFrame. The few operators that
must look at data before a plan can be written (fits, exact quantiles) run small
aggregations and bring back a fixed number of scalars.
"""
