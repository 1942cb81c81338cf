"""Vehicle sales and service analytics as plain Spark DataFrames."""
