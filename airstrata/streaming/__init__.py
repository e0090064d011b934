"""Structured Streaming jobs over the landing zone and the bronze tables."""
