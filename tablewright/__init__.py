"""Table preparation as plain Spark jobs: DataFrame in, DataFrame or table out."""
