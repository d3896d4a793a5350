"""Bound queries, one module per layer."""
