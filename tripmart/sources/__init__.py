"""Inputs: monthly trip files, lookup CSVs, and the lineitem-derived fixture."""
