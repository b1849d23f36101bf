"""riskweave: payment-risk analytics as Spark DataFrame and Structured Streaming jobs.

Layers: sources (fixtures, JSON, envelopes, catalog tables), operators
(medallion layers, fraud rules, warehouse loads, run reports), plans
(dashboard queries), streaming (medallion streams, alerts, live rules),
sinks (CSV, append, upsert).
"""

__version__ = "0.1.0"
