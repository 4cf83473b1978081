"""Operators of a training-data pipeline: filters, near and exact de-duplication, packing, scoring."""
