"""Operators for preparing training data. Nothing outside of this package imports it."""
