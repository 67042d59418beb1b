"""Table creation, plain writes and keyed upserts."""
