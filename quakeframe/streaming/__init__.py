"""Wiring of Structured Streaming queries. The statistics are those of the batch path."""
