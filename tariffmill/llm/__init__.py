"""Operators for preparing training text: scoring, extraction, deduplication, mixing and packing."""
