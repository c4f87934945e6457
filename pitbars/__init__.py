"""Point-in-time price bars on Spark."""
