"""Reusable DataFrame operators: joins on uneven keys, data checks, features, metrics."""
