"""Readers: CSV lots bound by name, event topics, cursor pulls, batch files and tables."""
