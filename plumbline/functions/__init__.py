"""Column-level building blocks, all made of Spark's built-in functions."""
