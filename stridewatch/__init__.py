"""Sensor time-series analytics and model monitoring on Spark DataFrames."""
