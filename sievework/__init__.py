"""Dataset curation and quality gates on Spark DataFrames."""
