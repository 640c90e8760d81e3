"""Scans: tables, sheets, file listings and JSON-lines results."""
