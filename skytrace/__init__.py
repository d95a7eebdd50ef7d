"""Aerial-survey analytics on Spark DataFrames."""
