"""Structured Streaming forms of harvest, incremental selection and the enriched view."""
