"""Reusable DataFrame operators: lookups, ordered picks, numbering, interval and rule matching."""
