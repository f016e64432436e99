"""Structured Streaming jobs; every transformation also runs on a batch frame."""
