"""Operators on training text: encoding, filtering, extraction, sharding, audits and language models."""
