"""Lead scoring and ranking on Spark."""
