"""Operators of a training-data pipeline over document, benchmark and conversation tables."""
