"""Operators of a training-data pipeline: filters, duplicate removal, scoring, archives and packing."""
