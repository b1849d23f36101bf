"""Query plans: the dashboard queries and their SQL oracles."""
