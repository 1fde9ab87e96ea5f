"""Analyses over a history of public-transport schedule snapshots, on Spark DataFrames."""

__version__ = "0.1.0"
