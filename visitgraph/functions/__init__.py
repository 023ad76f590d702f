"""Column functions on record text."""
