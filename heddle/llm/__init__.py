"""Operators for text collections that train language models. Nothing outside this package imports it."""
