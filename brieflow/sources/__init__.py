"""Scans and sinks: registries, lexicons, feeds, pages, run outputs."""
