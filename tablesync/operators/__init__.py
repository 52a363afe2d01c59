"""Operators on tables: batches, deltas, projections, views, merges."""
