"""Fixture views, the query catalogue, its SQL twins and whole jobs."""
