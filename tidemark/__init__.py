"""tidemark: statistical signal detection over entity time series, on Spark DataFrames."""
