"""Operators for preparing training corpora (deduplication, filtering, packing).

Nothing else in the package imports this subpackage.
"""
