"""Job-market analytics as plain PySpark: DataFrame in, DataFrame out."""
