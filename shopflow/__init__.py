"""Shopflow: clickstream analytics as Spark DataFrames."""
