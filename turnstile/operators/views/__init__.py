"""Measures: one place for each business rule."""
