"""Whole jobs: one table, a database of tables, and session settings."""
