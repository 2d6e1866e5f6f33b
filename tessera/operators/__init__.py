"""Operators over the engine's tables: selection, joins, aggregation, placement and tile geometry."""
