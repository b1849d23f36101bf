"""Structured Streaming jobs: medallion sinks, alerts, live rules."""
