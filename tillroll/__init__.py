"""Retail analytics on Spark: cleaning, facts, features, segments and forecasts."""
