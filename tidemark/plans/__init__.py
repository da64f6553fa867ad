"""Composed jobs, silver views and the registered query catalogue."""
