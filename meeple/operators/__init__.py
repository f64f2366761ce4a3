"""Reusable operators: top-k per group, reproducible sampling, table maintenance."""
