"""Readers of tables and derived work records."""
