"""Sources: driver-table fixtures, JSON-lines scans, stream envelopes, catalog tables."""
