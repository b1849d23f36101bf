"""Reusable column expressions (built-in Spark functions only)."""
from riskweave.functions.expressions import *  # noqa: F401,F403
