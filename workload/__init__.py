"""Queries that bind the library's operators to the given tables, with their oracle SQL."""
