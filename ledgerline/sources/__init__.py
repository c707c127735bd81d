"""Scans, gates, connectors, portal JSON, and the manifest-committed store."""
