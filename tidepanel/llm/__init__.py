"""Operators for preparing training text: licences, quality, duplicates, toxicity, mixing, HTML and packing."""
