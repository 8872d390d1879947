"""Joins, rollups, projections and snapshot operators."""
