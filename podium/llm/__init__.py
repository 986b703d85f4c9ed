"""Operators of a training-data pipeline: de-duplication, archives, language, mixing, output."""
