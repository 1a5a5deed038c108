"""Trailmark: navigation-traffic anomaly analytics on Spark DataFrames.

Tables in, tables out.  Every operator is a function from DataFrames to a
DataFrame; the caller owns the session and decides when to run an action.
"""
