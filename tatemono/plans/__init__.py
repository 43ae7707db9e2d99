"""Composite models: staging, lookups, mart, scoring."""
