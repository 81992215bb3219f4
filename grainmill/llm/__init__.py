"""Operators for training-data text: near-duplicates, representatives, packing, mixing, canonical text.

Nothing else in the library imports this subpackage.
"""
