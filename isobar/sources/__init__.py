"""Readers of tables, dimensions and landed payloads."""
