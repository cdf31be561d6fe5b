"""Spark jobs for timing-repair data, tensor cells, traces and training corpora."""
