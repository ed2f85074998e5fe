"""Importing this module registers every query."""

from checks import cleaning, profiling, retail, streams, validating  # noqa: F401
