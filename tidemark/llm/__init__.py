"""Operators on training text: deduplication, scoring, mixing, packing, archives, chat."""
