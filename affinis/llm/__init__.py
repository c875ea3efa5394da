"""Operators for large training-data pipelines over documents and web pages."""
