"""Operators for preparing training text: filtering, near duplicates, packing and formatting."""
