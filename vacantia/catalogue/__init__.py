"""Registered queries and their SQL twins, by topic."""
