"""Queries over the test tables, and workflows."""
