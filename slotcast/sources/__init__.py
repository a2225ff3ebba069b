"""Landed payloads, dimensions, period plans, feed preference, incremental starts."""
