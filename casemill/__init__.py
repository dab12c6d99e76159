"""Process-mining event logs on Spark: build, check and analyse them as DataFrames."""
