"""Customer-retention analytics on Spark: DataFrame in, DataFrame out."""
