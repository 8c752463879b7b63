"""Fundamental analysis of listed companies on Spark DataFrames."""
