"""Operators for preparing training text: packing, secret scans, deduplication,
chat formatting, quality scoring and rules, personal data, mixing, set joins
and language identification.

Nothing else in the library imports this package.
"""
