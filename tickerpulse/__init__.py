"""Social-post sentiment and daily-price analytics on Spark DataFrames."""
