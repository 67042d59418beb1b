"""Queries over readings, all DataFrame to DataFrame."""
