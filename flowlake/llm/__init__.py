"""Operators for preparing training data at scale; see the module docstrings."""
