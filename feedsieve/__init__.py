"""Trade data quality and quarantine on Spark DataFrames."""
