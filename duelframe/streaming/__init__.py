"""The incremental forms of the pipelines."""
