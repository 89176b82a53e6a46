"""Operators for preparing training text: scoring, token counts, scans, packing, similarity joins and filters."""
