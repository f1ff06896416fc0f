"""Dual-transcription corpus curation and evaluation as PySpark DataFrame operators."""
