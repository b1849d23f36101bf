"""Sinks: CSV reports, table append, keyed upsert."""
