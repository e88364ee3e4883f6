"""townlens: municipal contact analytics built on Spark DataFrames."""
