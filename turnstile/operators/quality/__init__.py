"""Data-quality suites."""
