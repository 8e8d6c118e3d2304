"""Contract-risk features, training sets and health scores on Spark."""
