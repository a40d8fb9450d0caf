"""Operators on DataFrames: merging, quality, series, freshness, scores, joins, graph."""
