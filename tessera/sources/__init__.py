"""Scans: driver tables, files with explicit schemas, in-memory literals,
and adapters that present the driver tables as retail / quotes data."""
