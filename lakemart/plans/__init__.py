"""Bindings to the benchmark tables and the query registry."""
