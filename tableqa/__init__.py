"""Land tables as Parquet and prove that the copy matches its source, on Spark DataFrames."""
