"""Growth and revenue analytics for subscription businesses, on Spark DataFrames."""
