"""Panels of (entity, UTC hour) -> value on Spark DataFrames.

Layers, from the bottom up: ``functions`` (column expressions and exact order
statistics), ``sources`` (files and tables), ``operators`` (one DataFrame in,
one DataFrame out), ``models`` (forecasters) and ``plans`` (composites).
"""
