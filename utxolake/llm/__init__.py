"""Operators of a training-data pipeline: deduplication, filtering, search, packing.

Nothing outside this subpackage imports it. ``queries`` registers one thin
query per operator; the operators keep general interfaces of their own.
"""
