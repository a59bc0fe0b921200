"""Vehicle-quality data processing on Spark DataFrames."""
