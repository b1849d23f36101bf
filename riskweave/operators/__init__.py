"""Operators: medallion layers, fraud rules, warehouse loads, run reports."""
