"""Operators of a training-data pipeline: filtering, dedup, privacy, mixing,
sharding, extraction, tokenising and vector search.  Nothing outside this
subpackage imports it."""
