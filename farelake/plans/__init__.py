"""Compositions of operators: the end-to-end pipeline and named queries."""
