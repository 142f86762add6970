"""Scans, manifests, series documents, table writes and staging."""
