"""Streaming sinks, audited tables and incremental change targets."""
