"""Composed jobs and the registry of checkable queries."""
