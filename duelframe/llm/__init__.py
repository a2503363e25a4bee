"""Operators for large training corpora, each a composition of Spark jobs."""
