"""Queries: operators applied to the project's tables."""
