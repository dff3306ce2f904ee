"""Panel building and data contracts on Spark DataFrames."""
