"""Default-risk models on Spark ML."""
