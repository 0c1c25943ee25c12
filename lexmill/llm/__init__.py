"""Operators for training-data pipelines over text. Nothing outside imports this package."""
