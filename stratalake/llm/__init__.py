"""Operators of a training-data pipeline: formatting, filters, near duplicates, scoring, packing, output."""
