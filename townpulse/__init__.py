"""Analytics for citizen complaints and power-outage notices on Spark DataFrames."""
