"""Operators for preparing training data: token files, near-duplicate search,
language ID, secret scans, packing, source mixing, fingerprints, chat turns.

Nothing else in the library imports this subpackage.
"""
