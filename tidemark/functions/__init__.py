"""Payload codecs and column helpers."""
