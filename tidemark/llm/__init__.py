"""Operators for building text training corpora. Nothing else in the library imports this package."""
