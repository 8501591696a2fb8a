"""Compositions of operators: the pipeline, and the queries over the driver tables."""
