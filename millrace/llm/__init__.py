"""Operators for building language-model training corpora, each a Spark job."""
