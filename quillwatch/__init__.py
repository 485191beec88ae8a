"""Contention analytics for collaboratively edited content, on Spark DataFrames."""
