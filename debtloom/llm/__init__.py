"""Operators for training data and for the entities named in it. Nothing outside this package imports it."""
