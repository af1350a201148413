"""Operators of a training-data pipeline (near-duplicates, packing, token
counts, personal data, quality, archives, mixing) and their queries.

Nothing else in the package imports this subpackage.
"""
