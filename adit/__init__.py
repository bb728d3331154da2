"""Road-tunnel sensor analytics on Spark, and operations for training-text pipelines."""
