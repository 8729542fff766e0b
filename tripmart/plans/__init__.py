"""Sinks, the monthly pipeline, and the registered queries with their oracles."""
