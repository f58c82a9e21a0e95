"""Training-data operators: thirteen corpus jobs, each a Spark job with its own module."""
