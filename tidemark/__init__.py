"""Product-analytics operators on Spark: DataFrames and an `as_of` date in, a DataFrame out."""
