"""DataFrame in, DataFrame out; no operator runs a Spark action."""
