"""Lectern: a Spark-first engine for corpora of lecture videos and their transcripts."""

__version__ = "0.1.0"
