"""Training-data preparation on Spark."""
