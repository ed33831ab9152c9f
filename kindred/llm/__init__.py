"""Operators for preparing training text: cleaning, duplicate removal, scoring, search and packing."""
