"""Incremental loading (batch high-water marks, keyed merges, month rebuilds)."""
