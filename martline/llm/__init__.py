"""Operators for preparing large text corpora. Nothing else in martline imports this package."""
