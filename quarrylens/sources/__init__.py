"""Feeds, tables and sinks."""
