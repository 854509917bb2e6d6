"""Marketplace sales analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; none creates a session, prints or keeps state.
"""
