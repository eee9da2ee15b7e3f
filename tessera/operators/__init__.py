"""Operators: each takes DataFrames and parameters and returns a DataFrame (no actions,
except the iteration checkpoints of graph and learning loops)."""
