"""Checks that run on batch and on Structured Streaming sources alike."""
